"""The corpus pipeline and the registered queries."""

import re
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tablecheck.llm import common, queries, toxicity
from tests.llm.helpers import documents, edited, jaccard_components, prose
from tests.llm.test_tokens import _check_pieces

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    want = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, got.select(*columns).collect()))) == sorted(map(repr, want.fetchall()))


def test_registered():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "secrets", "packing"]
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in entry.queries() if re.match(r"op\d+_", n))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


def test_library_does_not_need_this_folder():
    root = Path(__file__).parents[2]
    used = [p for p in [*root.glob("tablecheck/**/*.py"), root / "bench.py"] if "llm" not in p.parts and re.search(r"import.*\bllm\b|\.llm\b|corpus_pipeline", p.read_text())]
    assert used == []


@pytest.fixture()
def corpus(spark, tmp_path):
    """Documents with known toxic rows, copies, passages and secrets, and rows of nulls."""
    passage, base = prose(40, 80), prose(41, 120)
    texts = [prose(i, 90) for i in range(40)]
    texts += [base, edited(base, 1, 2), edited(base, 2, 1), base]  # 40..43
    texts += [f"{prose(100 + i, 60)} {passage} {prose(200 + i, 60)}" for i in range(4)]  # 44..47
    texts += [prose(300, 60) + " token=Zx81kQp0Lm3n end", prose(301, 50) + " such an idiot you moron"]  # 48, 49
    rows = [(i, t, "en", f"src{i % 3}") for i, t in enumerate(texts)] + [(50, None, None, None), (51, "", "en", "s"), (None, prose(500, 70), "en", "s")]
    labels = []
    for i in range(1000, 1200):
        toxic = i % 4 == 0
        rows.append((i, prose(i, 40) + (" idiot moron" if toxic else ""), "en", "s"))
        labels.append((i, 1, int(toxic)))
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_stages(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    columns, first = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    steps, kept = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        kept = common.materialise(stage(spark, kept, corpus), "test")
        steps[name] = kept
        assert name == "packing" or kept.columns == columns
    texts = {n: {r["doc_id"]: r["text"] for r in df.collect()} for n, df in steps.items() if n != "packing"}

    toxic = {i for i in first if i is not None and i >= 1000 and i % 4 == 0} | {49}
    assert set(texts["toxicity"]) == set(first) - toxic
    model = toxicity.fit(docs, spark.read.parquet(f"{corpus}/labels.parquet"))
    assert toxic == {i for i, t in first.items() if model.severity(t)[0] >= 0.5}

    groups = jaccard_components({i: t for i, t in texts["toxicity"].items() if i is not None}, 5, 80)
    assert set(texts["near_duplicates"]) == {i for i, c in groups.items() if i == c} | {None} and not {41, 42, 43} & set(texts["near_duplicates"])

    cut = texts["repeated_passages"]
    assert set(cut) == set(texts["near_duplicates"])
    assert cut[44] == first[44] and all(prose(40, 80) not in cut[i] and cut[i].split()[:60] == first[i].split()[:60] for i in (45, 46, 47))
    assert all(cut[i] == first[i] for i in cut if i not in (45, 46, 47))

    clean = texts["secrets"]
    assert clean[48] == first[48].replace("token=Zx81kQp0Lm3n", "[SECRET]")
    assert all(clean[i] == cut[i] for i in cut if i != 48)
    assert all(r["n_chars"] == len(r["text"] or "") for r in steps["secrets"].collect())
    _check_pieces(steps["packing"].collect(), clean, 4096)
    assert corpus_pipeline.run(spark, corpus).count() == steps["packing"].count()


def test_stages_on_long_texts_repeated_ids_and_clashing_columns(spark, tmp_path):
    long = " ".join([prose(900, 20_000), "token=Zx81kQp0Lm3n", prose(901, 30_000)])
    rows = [(i, prose(i, 60), "en", "s") for i in range(30)] + [(40, long, "en", "s"), (41, long + " tail", "en", "s"), (5, prose(5, 60), "en", "s"), (5, prose(910, 70), "en", "s"), (None, prose(911, 70), None, None), (None, None, None, None)]
    docs = documents(spark, rows, extra=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i in range(30)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = spark.read.parquet(f"{tmp_path}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES:
        kept = common.materialise(stage(spark, kept, str(tmp_path)), "edge")
        counts.append(kept.count())
        assert name == "packing" or kept.columns == docs.columns
        if name == "secrets":
            texts = [r["text"] for r in kept.where("doc_id = 40").collect()]
            assert len(texts) == 1 and "[SECRET]" in texts[0] and len(texts[0].split()) == 50_001
            assert kept.where("doc_id = 41").count() == 0 and kept.where("doc_id = 5").count() == 3 and kept.where("doc_id is null").count() == 2
    assert counts[:2] == [36, 35] and counts[2] == 35


def test_empty_tables(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_entry_without_this_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(entry, "ROOT", tmp_path)
    assert not [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()] and "pipeline" not in entry.queries()
    (tmp_path / "tablecheck" / "llm").mkdir(parents=True)
    assert "pipeline" not in entry.queries()


def test_entry_does_not_hide_a_broken_module(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    with pytest.raises(ImportError):
        entry.queries()
