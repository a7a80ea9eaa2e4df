"""The prefix trie of rebuilt conversations, by composable fingerprints.

A conversation ``c`` is rebuilt from the first ``head`` turns of its base conversation and its own turns after its first
``head``.  No rebuilt text is ever made: the fingerprint of a turn sequence is ``V(s1 .. sn) = sum of si * B^(i-1)`` modulo a prime of 127
bits, ``si`` the SHA-256 of a turn's role and text.  ``V(u v) = V(u) + B^|u| * V(v)`` makes it a monoid, so

* prefix products over one conversation's turns are computed for each range partition alone, and composed afterwards: a conversation
  of a third of all rows is cut by turn ranges into many tasks (one carry row for each partition goes through the driver);
* the fingerprint of a rebuilt prefix is composed from the base's head product and the product of a stretch of own turns.

Prefixes with equal fingerprints and depths are a node.  Every member keeps a reference ``(conversation, position)`` to its last turn,
and groups are verified: all members have one parent, and all referenced stored turns have one SHA-256.  Should any
group fail, everything is done anew with the next modulus and base.

Subtree sums need no walk over levels.  A node's members are the conversations through it, and its name is the smallest of them; a
conversation names a tail of its path, from some depth on.  So a node's leaves are those members that name a childless node, and
its repeated characters are, over the members other than its name, their characters from the node on less those
of the nodes that they name: both are plain sums over members, combined before the shuffle.

The digest of a node's ending conversations is a stream: ids are dealt by node and sorted, and a running SHA-256 reads them in
constant memory.

Edge cases: a null role or text is empty; rows with a null conversation belong to none; a null turn comes first; equal turn
numbers are ordered by the SHA-256 of their turns, and repeated rows are turns of their own; a base that is absent has no
turns; a conversation without rebuilt turns ends at the root; an empty table has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise

#: Moduli and bases, tried in order; a Mersenne prime leaves room for 16 bytes.
MODULI = ((2**127 - 1, 0x2545F4914F6CDD1D2545F4914F6CDD1D), (2**127 - 1, 0x9E3779B97F4A7C159E3779B97F4A7C15), (2**107 - 1, 0xD1342543DE82EF95))


def turn_rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``(conv, turn, digest, chars)``: each turn's SHA-256 of role and text, and its code points."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    return df.where(F.col(conv_col).isNotNull()).select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("chars"))


def _symbol(digest: bytes, prime: int) -> int:
    return int.from_bytes(digest, "little") % prime


def prefix_products(rows: DataFrame, prime: int, base: int) -> DataFrame:
    """``(part, first, row, conv, pos, product, cum, chars, digest)``: within each range partition, products and characters up to each turn.

    ``first`` marks the partition's first conversation, the only one that an earlier partition may have begun.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, lead, n, pos, value, power, cum = TaskContext.get().partitionId(), None, False, 0, 0, 0, 1, 0
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for c, digest, chars in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if c != conv:
                    lead = conv is None
                    conv, pos, value, power, cum = c, 0, 0, 1, 0
                pos, value, power, cum = pos + 1, (value + power * _symbol(digest, prime)) % prime, power * base % prime, cum + chars
                for column, x in zip(out, (lead, n, pos, value.to_bytes(16, "big"), cum)):
                    column.append(x)
                n += 1
            first, row, at, product, total = (pa.array(x, k) for x, k in zip(out, (pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array([part] * batch.num_rows, pa.int32()), first, row, batch.column(0), at, product, total, batch.column(3), batch.column(2)], names=["part", "first", "row", "conv", "pos", "product", "cum", "chars", "digest"])

    order = ["conv", F.asc_nulls_first("turn"), "digest"]
    kind = rows.schema["conv"].dataType.simpleString()
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranged.mapInArrow(run, f"part int, first boolean, row long, conv {kind}, pos long, product binary, cum long, chars long, digest binary")


def _carries(rows: DataFrame, prime: int, base: int) -> dict[int, tuple[int, int, int]]:
    """What stands before each partition's first conversation, where an earlier partition began it: ``{part: (turns, product, characters)}``."""
    state = F.struct("row", "conv", "pos", "product", "cum")
    ends = rows.groupBy("part").agg(F.max(F.when(F.col("first"), state)).alias("head"), F.max(state).alias("tail")).orderBy("part").collect()  # one row for each partition
    carries, conv, turns, value, cum = {}, None, 0, 0, 0
    for r in ends:
        if r["head"]["conv"] == conv:
            carries[r["part"]] = (turns, value, cum)
        else:
            turns, value, cum = 0, 0, 0
        if r["tail"]["conv"] != r["head"]["conv"]:
            turns, value, cum = 0, 0, 0
        conv, own = r["tail"]["conv"], r["tail"]
        value = (value + pow(base, turns, prime) * int.from_bytes(own["product"], "big")) % prime
        turns, cum = turns + own["pos"], cum + own["cum"]
    return carries


def settled(rows: DataFrame, prime: int, base: int) -> DataFrame:
    """``(conv, pos, product, cum, chars, digest)`` over whole conversations."""
    columns = ["conv", "pos", "product", "cum", "chars", "digest"]
    carries = _carries(rows, prime, base)
    if not carries:
        return rows.select(*columns)
    late = F.col("first") & F.col("part").isin(list(carries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = {part: pow(base, turns, prime) for part, (turns, _, _) in carries.items()}
        for batch in batches:
            before = [carries[p] for p in batch.column(0).to_pylist()]
            product = [((v + powers[p] * int.from_bytes(x, "big")) % prime).to_bytes(16, "big") for p, (_, v, _), x in zip(batch.column(0).to_pylist(), before, batch.column(3).to_pylist())]
            pos = pa.array([b[0] + x for b, x in zip(before, batch.column(2).to_pylist())], pa.int64())
            cum = pa.array([b[2] + x for b, x in zip(before, batch.column(4).to_pylist())], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(1), pos, pa.array(product, pa.binary()), cum, batch.column(5), batch.column(6)], names=columns)

    whole = rows.where(~late).select(*columns)
    return whole.unionByName(rows.where(late).select("part", *columns).mapInArrow(run, whole.schema))


def conversations(turns: DataFrame, head: Column, base: Column, max_head: int) -> DataFrame:
    """One row for each conversation: its base's head products, what its own first ``head`` turns come to, and the rebuilt length and characters."""
    state = F.struct("pos", "product", "cum")
    own = turns.withColumn("h", head).groupBy("conv", "h").agg(F.max("pos").alias("n"), F.max("cum").alias("all"), F.max(F.when(F.col("pos") <= F.col("h"), state)).alias("skip"))
    own = own.withColumn("base", base)
    heads = turns.where(F.col("pos") <= max_head).join(own.select(F.col("base").alias("conv")).distinct(), "conv", "left_semi")
    heads = heads.groupBy(F.col("conv").alias("of")).agg(F.array_sort(F.collect_list(F.struct("pos", "product", "cum", "chars"))).alias("heads"))  # at most max_head turns
    rows = own.join(heads, F.col("base") == F.col("of"), "left").withColumn("heads", F.slice(F.coalesce("heads", F.array()), 1, F.greatest(F.col("h"), F.lit(0)).cast("int")))
    rows = rows.withColumn("hb", F.size("heads")).withColumn("before", F.coalesce(F.try_element_at("heads", F.lit(-1))["cum"], F.lit(0)))
    return rows.select(
        "conv", "h", "base", "heads", "hb", "before", F.col("skip.product").alias("skip"), F.coalesce("skip.cum", F.lit(0)).alias("skipped"),
        (F.col("hb") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length"),
        (F.col("before") + F.when(F.col("n") > F.col("h"), F.col("all") - F.coalesce("skip.cum", F.lit(0))).otherwise(0)).alias("total"),
    )


def members(turns: DataFrame, convs: DataFrame, head: Column, prime: int, base: int) -> DataFrame:
    """``(conv, depth, f1, f2, p1, p2, ref_conv, ref_pos, chars, pre, total, ends)``: every rebuilt prefix with its own and its parent's fingerprint and a reference to its last turn."""
    kind = turns.schema["conv"].dataType.simpleString()
    shape = f"conv {kind}, depth long, own binary, parent binary, ref_conv {kind}, ref_pos long, chars long, pre long, total long, length long"
    none = F.lit(bytes(16))
    spread = convs.select("*", F.explode(F.sequence(F.lit(0), "hb")).alias("d"))
    turn, up = F.get("heads", F.col("d") - 1), F.get("heads", F.col("d") - 2)
    heads = spread.select(
        "conv", F.col("d").cast("long").alias("depth"), F.coalesce(turn["product"], none).alias("own"), F.when(F.col("d") > 0, F.coalesce(up["product"], none)).alias("parent"),
        F.when(F.col("d") > 0, F.col("base")).alias("ref_conv"), F.col("d").cast("long").alias("ref_pos"), F.coalesce(turn["chars"], F.lit(0)).alias("chars"), F.coalesce(up["cum"], F.lit(0)).alias("pre"), "total", "length",
    )
    later = turns.withColumn("h", head).where("pos > h").drop("h").join(convs.select("conv", "h", "hb", F.coalesce(F.try_element_at("heads", F.lit(-1))["product"], none).alias("top"), F.coalesce("skip", none).alias("skip"), "before", "skipped", "length", "total"), "conv")
    later = later.select("conv", (F.col("pos") - F.col("h") + F.col("hb")).alias("depth"), "product", "top", "skip", (F.col("hb") - F.col("h")).alias("shift"), "digest", "pos", "chars", (F.col("before") + F.col("cum") - F.col("chars") - F.col("skipped")).alias("pre"), "total", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers: dict[int, int] = {}
        for batch in batches:
            depth, product, top, skip, shift, digest = (batch.column(i).to_pylist() for i in range(1, 7))
            own, parent = [], []
            for d, v, t, s, k, x in zip(depth, product, top, skip, shift, digest):
                if k not in powers:
                    powers[k] = pow(base, k, prime)
                value = (int.from_bytes(t, "big") + powers[k] * (int.from_bytes(v, "big") - int.from_bytes(s, "big"))) % prime
                own.append(value.to_bytes(16, "big"))
                parent.append(((value - pow(base, d - 1, prime) * _symbol(x, prime)) % prime).to_bytes(16, "big"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(own, pa.binary()), pa.array(parent, pa.binary()), batch.column(0), batch.column(7), *(batch.column(i) for i in range(8, 12))], names=[x.split()[0] for x in shape.split(", ")])

    rows = heads.unionByName(later.mapInArrow(run, shape))
    half = lambda c, at: F.conv(F.hex(F.substring(c, at, F.lit(8))), 16, -10).cast("long")
    return rows.select("conv", "depth", half("own", 1).alias("f1"), half("own", 9).alias("f2"), half("parent", 1).alias("p1"), half("parent", 9).alias("p2"), "ref_conv", "ref_pos", "chars", "pre", "total", (F.col("depth") == F.col("length")).alias("ends"))


KEY = ["depth", "f1", "f2"]


def _groups(rows: DataFrame) -> DataFrame:
    """Nodes with what their members must agree on as smallest and largest values."""
    both = [f(c).alias(f"{f.__name__}_{c}") for c in ("p1", "p2", "chars", "pre", "ref_conv", "ref_pos") for f in (F.min, F.max)]
    return rows.groupBy(*KEY).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), *both)


def _collisions(groups: DataFrame, rows: DataFrame, turns: DataFrame) -> bool:
    """Whether any group holds different prefixes: parents that differ, or referenced turns that differ."""
    apart = lambda *cs: " or ".join(f"min_{c} <> max_{c}" for c in cs)
    if groups.where(apart("p1", "p2", "chars", "pre")).limit(1).count():
        return True
    several = groups.where(apart("ref_conv", "ref_pos")).select(*KEY)
    refs = rows.join(several, KEY, "left_semi").select(*KEY, F.col("ref_conv").alias("conv"), F.col("ref_pos").alias("pos")).distinct()
    seen = refs.join(turns.select("conv", "pos", "digest"), ["conv", "pos"]).groupBy(*KEY).agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
    return seen.where("a <> b").limit(1).count() > 0


def _ends(rows: DataFrame) -> DataFrame:
    """``(depth, f1, f2, ends_sha256)`` of the nodes where conversations end: SHA-256 of their ids, ascending and comma-joined."""
    kind = "depth long, f1 long, f2 long, ends_sha256 string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            out = []
            for *key, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if key == node:
                    sha.update(f",{conv}".encode())
                else:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256(str(conv).encode())
            yield _table(out)
        if node:
            yield _table([(*node, sha.hexdigest())])

    def _table(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, (*[pa.int64()] * 3, pa.string()))], names=[*KEY, "ends_sha256"])

    return rows.where("ends").select(*KEY, "conv").repartition(*KEY).sortWithinPartitions(*KEY, "conv").mapInArrow(run, kind)


def prefix_trie(df: DataFrame, head: Column, base: Column, max_head: int, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", moduli: Sequence[tuple[int, int]] = MODULI) -> DataFrame:
    """``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)`` for every node.

    ``head`` (at most ``max_head``) and ``base`` are expressions over the column ``conv``, a conversation's id.
    """
    rows = turn_rows(df, conv_col, turn_col, role_col, text_col)
    for prime, point in moduli:
        turns = settled(materialise(prefix_products(rows, prime, point), "turns"), prime, point)
        convs = materialise(conversations(turns, head, base, max_head), "conversations")
        paths = materialise(members(turns, convs, head, prime, point), "members")
        groups = materialise(_groups(paths), "groups")
        if not _collisions(groups, paths, turns):
            break
    else:
        raise RuntimeError("fingerprints collide with every modulus")

    nodes = groups.select(*KEY, F.col("min_p1").alias("p1"), F.col("min_p2").alias("p2"), "conv_id", "n_convs", F.col("min_chars").alias("chars"))
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2")).agg(F.count("*").alias("n_children"))
    nodes = materialise(nodes.join(kids, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")

    named = nodes.groupBy(F.col("conv_id").alias("conv")).agg(F.min("depth").alias("from"), F.sum("chars").alias("named"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf"))
    own = paths.select(*KEY, "conv", (F.col("total") - F.col("pre")).alias("rest")).join(named, "conv", "left")
    sums = own.groupBy(*KEY).agg(F.sum(F.coalesce("leaf", F.lit(0))).alias("n_leaves"), F.sum(F.when(F.coalesce(F.col("depth") >= F.col("from"), F.lit(False)), 0).otherwise(F.col("rest") - F.coalesce("named", F.lit(0)))).alias("saved_tokens"))
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, KEY).join(_ends(paths), KEY, "left").join(above, ["depth", "p1", "p2"], "left")
    return out.select(F.col("conv_id").alias(conv_col), "depth", "parent_conv_id", "n_convs", F.col("n_children").cast("long").alias("n_children"), F.col("n_leaves").cast("long").alias("n_leaves"), F.col("saved_tokens").cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
