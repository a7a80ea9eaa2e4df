"""Secret scan with corpus-wide ownership frequency; DataFrame operations only.

Every text is searched for the base kinds and for generic credential-like runs.  Each
candidate value is hashed, and the hashes are aggregated over the whole corpus by distinct
owner and repository.  A value that several owners or very many repositories hold is a widely copied example; one that
a single owner (or too few) holds in few repositories and that looks random is live.  The base spans
are always reported; a generic run is added only when it is live.

Positions come from two regular expression passes over texts that hold a match: the
matches themselves and the pieces between them (``split``) alternate, so the running
sum of their lengths gives every start.  The work grows in proportion to a text and its spans (running results are made by
blocks, overlaps are found in the sorted spans, counts join span by span).

Skew: hashes are counted through partial aggregates, so a value that a third of all rows hold is
combined before the shuffle.  The counts go back to documents by a plain equi-join,
whose hot partitions AQE splits.

Edge cases: a null text is empty; a null owner or repository counts as the empty name; rows
with the same id are kept apart and judged by the same corpus counts; an empty table gives
no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from .common import free_name, materialise

#: Base kinds in the order they are listed (fixed patterns).
ASSIGN = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
GENERIC = r"[A-Za-z0-9+/_-]+"
KINDS = ("assign", "access", "hex", "generic")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX, MIN_GENERIC = 6, 20, 24, 20


#: Values of one block of a running result.
BLOCK = 256


def running(values: Column, zero: Column, add: Callable[[Column, Column], Column]) -> Column:
    """The array of running results of an associative ``add`` over an array.

    A fold that appends copies what it has at every step, so it runs over blocks, each from the result of the
    blocks before it.  Arrays are bound as lambda variables, which makes each of them once.
    """
    def append(acc: Column, x: Column) -> Column:
        return F.concat(acc, F.array(add(F.element_at(acc, -1), x)))

    def joined(x: Column) -> Column:
        blocks, starts = x["blocks"], x["starts"]
        return F.flatten(F.transform(blocks, lambda block, i: F.slice(F.aggregate(block, F.array(F.get(starts, i)), append), 2, BLOCK)))

    full = F.filter(F.array(values), lambda v: F.size(v) > 0)
    cut = F.transform(full, lambda v: F.transform(F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int")), lambda j: F.slice(v, j * BLOCK + 1, BLOCK)))
    sums = F.transform(cut, lambda blocks: F.struct(blocks.alias("blocks"), F.aggregate(F.transform(blocks, lambda block: F.aggregate(block, zero, add)), F.array(zero), append).alias("starts")))
    return F.coalesce(F.get(F.transform(sums, joined), 0), F.array().cast("array<int>"))


def _candidates(text: Column, kind: int, pattern: str, may: Column, group: int, least: int) -> Column:
    """Array of ``(start, kind, stop, value)``: leftmost non-overlapping matches whose ``group`` has ``least`` characters."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if group else found
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,value:string>>")
    # The pieces between matches and the matches alternate: running sums of their lengths are the stops.
    both = F.zip_with(F.slice(F.split(text, pattern), 1, F.size(found)), found, lambda g, h: F.length(g) + F.length(h))
    spans = F.zip_with(F.arrays_zip(found.alias("hit"), value.alias("value")), running(both, F.lit(0), lambda a, b: a + b), lambda p, stop: F.struct((stop - F.length(p["hit"])).alias("start"), F.lit(kind).alias("kind"), stop.alias("stop"), p["value"].alias("value")))
    return F.when(may, F.filter(spans, lambda s: F.length(s["value"]) >= least)).otherwise(none)


def version_of(text_col: str) -> Column:
    """Hash of a row's text: tells rows of one id apart."""
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo: Column | None = None) -> DataFrame:
    """``(id, version, owner, repo, spans)``: base spans and generic candidates of every row, with the hash of each value."""
    repo = F.coalesce(repo if repo is not None else F.col(owner_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(owner_col), F.lit("")).alias("owner"), repo.alias("repo"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), version_of(text_col).alias("version"))
    # A run of at least the smallest length decides cheaply whether a text is searched for positions at all; a maximal run
    # of that length is the same match as an unbounded one that passes, so the bounded pattern is used for those kinds.
    text = F.col("text")
    rows = rows.select(
        "id", "version", "owner", "repo",
        F.concat(
            _candidates(text, 0, ASSIGN, (text.contains(":") | text.contains("=")) & text.rlike(ASSIGN), 1, MIN_ASSIGN),
            _candidates(text, 1, ACCESS[:-1] + "{%d,}" % (MIN_ACCESS - 4), text.contains("AKIA"), 0, MIN_ACCESS),
            _candidates(text, 2, HEX[:-1] + "{%d,}" % MIN_HEX, text.rlike(HEX[:-1] + "{%d}" % MIN_HEX), 0, MIN_HEX),
            _candidates(text, 3, GENERIC[:-1] + "{%d,}" % MIN_GENERIC, text.rlike(GENERIC[:-1] + "{%d}" % MIN_GENERIC), 0, MIN_GENERIC),
        ).alias("found"),
    )
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]")
    rows = rows.select("id", "version", "owner", "repo", F.array_sort(F.filter("found", lambda s: (s["kind"] < 3) | mixed(s))).alias("found"))
    # A generic span is apart from all base spans if those that start before it stop before it, and the next one starts after it.
    before = running(F.transform("found", lambda s: F.when(s["kind"] < 3, s["stop"]).otherwise(0)), F.lit(0), lambda a, b: F.greatest(a, b))
    last = 2**31 - 1
    after = F.reverse(running(F.reverse(F.transform("found", lambda s: F.when(s["kind"] < 3, s["start"]).otherwise(last))), F.lit(last), lambda a, b: F.least(a, b)))
    rows = rows.select("id", "version", "owner", "repo", F.arrays_zip(F.col("found").alias("s"), before.alias("before"), after.alias("after")).alias("found"))
    apart = F.filter("found", lambda x: (x["s"]["kind"] < 3) | ((x["before"] <= x["s"]["start"]) & (x["after"] >= x["s"]["stop"])))
    spans = F.transform(apart, lambda x: F.struct(x["s"]["start"].alias("start"), x["s"]["kind"].alias("kind"), x["s"]["stop"].alias("stop"), F.sha2(x["s"]["value"], 256).alias("hash"), (F.size(F.array_distinct(F.split(x["s"]["value"], ""))) > 5).alias("random")))
    return rows.select("id", "version", "owner", "repo", spans.alias("spans"))


def ownership(found: DataFrame) -> DataFrame:
    """``(hash, n_owners, n_repos)`` over the whole corpus."""
    hits = found.select("owner", "repo", F.explode("spans").alias("s")).select(F.col("s.hash").alias("hash"), "owner", "repo")
    return hits.groupBy("hash", "owner", "repo").agg(F.count("*").alias("n")).groupBy("hash", "owner").agg(F.count("*").alias("n")).groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repos"))


def _list(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["stop"])), ",")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo: Column | None = None, example_owners: int = 3, example_repos: int = 8) -> DataFrame:
    """``(id, version, spans)`` for every row: an array of ``(start, kind, stop, hash, n_owners, n_repos, live)``.

    A value held by at least ``example_owners`` owners, or by ``example_repos`` repositories of whatever owners, is an example; any
    other whose value has more than five different characters is live.  Generic spans that are not live are dropped.
    """
    found = materialise(candidates(df, id_col, text_col, owner_col, repo), "secrets")
    # Counts join span by span, so a document of many spans is many rows; rows that repeat an id and a text are judged once.
    marked = found.where(F.size("spans") > 0).select("id", "version", "spans").dropDuplicates(["id", "version"])
    each = marked.select("id", "version", F.explode("spans").alias("s")).select("id", "version", "s.*")
    live = F.col("random") & (F.col("n_owners") < example_owners) & (F.col("n_repos") < example_repos)
    each = each.join(ownership(found), "hash").withColumn("live", live).where((F.col("kind") < 3) | F.col("live"))
    judged = each.groupBy(F.col("id").alias("marked"), F.col("version").alias("marked_version")).agg(F.array_sort(F.collect_list(F.struct("start", "kind", "stop", "hash", "n_owners", "n_repos", "live"))).alias("judged"))  # a document's spans
    rows = found.select("id", "version").join(judged, F.col("id").eqNullSafe(F.col("marked")) & (F.col("version") == F.col("marked_version")), "left")
    none = F.array().cast("array<struct<start:int,kind:int,stop:int,hash:string,n_owners:long,n_repos:long,live:boolean>>")
    return rows.select(F.col("id").alias(id_col), "version", F.coalesce("judged", none).alias("spans"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts by kind, the digest of the base spans, the list of all spans, and how widely the most copied value is held."""
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda test: F.size(F.filter("spans", test)).cast("long")
    of_kind = lambda k: count(lambda s: s["kind"] == k)
    most = lambda name: F.coalesce(F.array_max(F.col(f"spans.{name}")), F.lit(0)).cast("long").alias(f"max_{name[2:]}")
    return scanned.select(
        id_col,
        *[of_kind(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(_list(base), 256).alias("base_sha256"),
        _list(F.col("spans")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_example"),
        most("n_owners"),
        most("n_repos"),
    )


def redact(df: DataFrame, scanned: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with every live span replaced by ``mark``; overlapping spans become one mark."""
    marked, version, live = (free_name(df, n) for n in ("marked", "marked_version", "live"))
    spans = scanned.select(F.col(id_col).alias(marked), F.col("version").alias(version), F.filter("spans", lambda s: s["live"]).alias(live)).where(F.size(live) > 0).groupBy(marked, version).agg(F.first(live).alias(live))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col(text_col)
    step = lambda acc, s: F.when(s["stop"] <= acc["at"], acc).otherwise(F.struct(s["stop"].alias("at"), F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"]).alias("out")))
    cut = F.aggregate(live, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    joined = df.join(spans, F.col(id_col).eqNullSafe(F.col(marked)) & (version_of(text_col) == F.col(version)), "left")
    return joined.withColumn(text_col, F.when(F.col(live).isNotNull() & text.isNotNull(), cut).otherwise(text)).select(*df.columns)
