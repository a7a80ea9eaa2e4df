"""Near duplicates, vectors, passages and archives (op7, op8, op6, op3) and components."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tablecheck.llm import chaining, common, jaccard, pstable, warc
from tests.llm.helpers import ODD, components, documents, edited, jaccard_components, prose, shingles


@pytest.mark.parametrize("seed", range(3))
def test_connected_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)] + [(200, 200 + i) for i in range(1, 40)]
    want = components({x for e in links for x in e if e[0] != e[1]}, links)
    got = common.connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert common.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def near_copies():
    base, other = prose(100, 160), prose(101, 90)
    line = prose(102, 30)
    texts = [*ODD, base, base.upper(), *(edited(base, i, 1 + i % 6) for i in range(40)), *(edited(other, i, i % 4) for i in range(20)), *(f"{prose(200 + i, 60)} {line}" for i in range(25))]
    chain = [prose(300, 120)]
    for i in range(12):  # each links with the next, the ends don't
        chain.append(edited(chain[-1], 500 + i, 1))
    return texts + chain + [line] * 30 + [line + " more"] * 3


@pytest.mark.parametrize("k, percent, common_size", [(4, 85, 200_000), (5, 80, 3), (4, 85, 0)])
def test_jaccard_join_is_exact(spark, k, percent, common_size):
    texts = dict(enumerate(near_copies()))
    rows = jaccard.jaccard_join(documents(spark, list(texts.values()), extra=True).repartition(3), k=k, percent=percent, common=max(common_size, 1)).collect()
    assert {r["doc_id"]: r["component_id"] for r in rows} == jaccard_components(texts, k, percent)
    assert all(r["n_shingles"] == len(shingles(texts[r["doc_id"]], k)) for r in rows) and len(rows) == len(texts)


def test_components_that_meet_in_many_cells_meet_once(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 2)
    member = "id long, n long, sketch array<long>, c long"
    inside = [(i, 100, [0] * 4, 1 if i < 6 else i) for i in range(1, 9)] + [(9, 100, [-1] * 4, 9)]
    cells = [(key, 1, i) for key in range(50) for i in (1, 2, 3, 4, 5, 6, 9)] + [(99, 1, 2), (99, 1, 7), (98, 1, 7), (98, 1, 8)]  # 7 meets only 2 of the larger component
    rows = {r[0]: r for r in inside}
    place = spark.createDataFrame([(key, band, rows[i][3], *rows[i][:3]) for key, band, i in cells], "key long, band long, c long, id long, n long, sketch array<long>")
    got = [tuple(sorted(r)) for r in jaccard.across(place, spark.createDataFrame(inside, member), 80).collect()]
    assert sorted(got) == [(1, 6), (2, 6), (2, 7), (3, 6), (4, 6), (5, 6), (7, 8)]


def test_jaccard_edges(spark):
    text = prose(1, 50)
    rows = jaccard.jaccard_join(documents(spark, [(5, text, "en", "a"), (None, text, None, None), (7, text, "en", "a"), (7, text, "en", "a"), (7, "quite other words stand here", "en", "a"), (8, None, "en", "a")])).collect()
    assert Counter((r["doc_id"], r["component_id"]) for r in rows) == Counter({(5, 5): 1, (None, None): 1, (7, 5): 2, (7, 7): 1, (8, 8): 1})
    assert jaccard.jaccard_join(documents(spark, [])).collect() == []


def vector_rows(n=160, dim=16):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((n, dim))
    near = [base[i % 6] + 0.12 * rng.standard_normal(dim) for i in range(120)]
    rows = [x.tolist() for x in [*base, *near]] + [base[0].tolist()] * 25 + [(3 * base[1]).tolist()]
    return rows + [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] * dim, [1.0, 2.0], [2.0, 4.0]]


@pytest.mark.parametrize("block", [2048, 20])
def test_vectors_against_all_pairs(spark, block):
    rows = vector_rows()
    unit = [pstable.unit(r) for r in rows]
    links = {(i, j) for i, x in enumerate(unit) for j, y in enumerate(unit) if i != j and x is not None and y is not None and len(x) == len(y) and x @ y >= 0.95}
    df = spark.createDataFrame([(i, r, 0) for i, r in enumerate(rows)], "vec_id long, embedding array<double>, key int").repartition(3)
    got = pstable.near_vectors(df, block=block, n_tables=40).collect()
    want, n = components(range(len(rows)), links), Counter(i for i, _ in links)
    assert {r["vec_id"]: r["n_links"] for r in got} == {i: n[i] for i in range(len(rows))}
    assert {r["vec_id"]: (r["component_id"], r["kept"]) for r in got} == {i: (c, c == i) for i, c in want.items()}


def test_vector_edges(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 1.0]), (2, None)]
    got = pstable.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert Counter(map(tuple, got)) == Counter({(1, 2, 1, True): 2, (None, 2, None, True): 1, (None, 0, None, True): 1, (2, 0, 2, True): 1})
    assert pstable.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    side = rng.standard_normal((400, 64))
    side -= (side * x).sum(1)[:, None] * x
    side /= np.linalg.norm(side, axis=1)[:, None]
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * side
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(np.concatenate((x, y)))], "vec_id long, embedding array<double>")
    assert sum(r["n_links"] for r in pstable.near_vectors(df).collect()) >= 0.95 * 800


def test_texts_that_share_too_few_words_are_not_aligned(monkeypatch):
    rng, calls = np.random.default_rng(5), []
    x, y = (rng.integers(0, 1 << 24, 160).astype("<u4") for _ in range(2))
    for at in (60, 80, 100):
        y[at : at + 5] = x[at : at + 5]
    aligned = chaining.equal_runs
    monkeypatch.setattr(chaining, "equal_runs", lambda *a: calls.append(a) or aligned(*a))
    assert chaining.align_row(x, y, [60, 80, 100], [60, 80, 100], 5, 50, 80) == [] and not calls  # fifteen words in common
    y[50:110] = x[50:110]
    assert [r[:2] for r in chaining.align_row(x, y, [60, 80, 100], [60, 80, 100], 5, 50, 80)] == [(50, 110)] and calls


def test_words_of_blocks_and_order_of_seeds():
    texts = [*ODD, None, " outer \x0b space\n", "a\x1cb c\x85d É e\x00f"]
    assert list(chaining.texts_to_words(pa.array(texts, pa.string()))) == [chaining.to_words(t) for t in texts]
    assert list(chaining.texts_to_words(pa.array([], pa.string()))) == []
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 3000):
        key, rank, pos = rng.integers(0, 900, n).astype(np.uint64) << np.uint64(50), rng.integers(0, 40, n), rng.integers(0, 99, n)
        for by in (np.arange(n), np.lexsort((pos, rank))):
            assert chaining.in_order(key[by], rank[by], pos[by]).tolist() == np.lexsort((pos[by], rank[by], key[by])).tolist()


@pytest.mark.parametrize("seed", range(20))
def test_chain_score_is_the_best(seed):
    rng = random.Random(seed)
    matches = sorted({(rng.randrange(60), rng.randrange(60)) for _ in range(14)})
    score = []
    for i, (a, b) in enumerate(matches):
        gains = [score[j] - chaining.GAP_COST * (a - c + b - d) for j, (c, d) in enumerate(matches[:i]) if c < a and d < b]
        score.append(chaining.K + max([0, *gains]))
    chains = chaining.chain(matches)
    assert sorted(m for own in chains for m in own) == matches
    worth = lambda own: chaining.K * len(own) - chaining.GAP_COST * sum(c - a + d - b for (a, b), (c, d) in zip(own, own[1:]))
    assert all(a < c and b < d for own in chains for (a, b), (c, d) in zip(own, own[1:]))
    assert max(map(worth, chains)) == pytest.approx(max(score)) or len(chains) == 1


def test_alignment_counts_words():
    x = list("abcdefghijklmnopqrstuvwxyz")
    y = list("zzabcdefghijKlmnopqrSTuvwxyzz")
    assert chaining.matched(list("abcd"), list("axcd")) == 3 and chaining.matched([], list("ab")) == 0
    assert chaining.align(x, y, [(0, 2), (20, 22)]) == (0, 26, 2, 28, 23)


def passage_texts():
    shared, fuzzy, short = prose(50, 70), prose(51, 120), prose(52, 30)
    texts = [f"{prose(600 + i, 80)} {shared} {prose(700 + i, 60)}" for i in range(12)]
    texts += [f"{prose(800 + i, 40)} {' '.join(f'edit{i}' if j in (15 + 7 * i, 55 + 7 * i) else w for j, w in enumerate(fuzzy.split()))} {prose(900 + i, 90)}" for i in range(6)]
    texts += [f"{prose(1000 + i, 60)} {short} {prose(1100 + i, 60)}" for i in range(6)]
    return texts + [prose(1200, 300), prose(1200, 300), *["\n".join(["this one line is long enough to be seeded again and again"] * 20)] * 2, *ODD]


def test_passages(spark):
    texts = passage_texts()
    docs = documents(spark, texts, extra=True).repartition(3)
    found = chaining.passages(docs)
    rows = found.collect()
    spans = {}
    for r in rows:
        assert r["ref_id"] < r["doc_id"] and r["stop"] - r["start"] >= 50
        spans.setdefault(r["doc_id"], []).append((r["start"], r["stop"]))
    for i in range(1, 12):
        (a, b), = spans[i]
        assert abs(a - 80) <= 2 and abs(b - 150) <= 2
    for i in range(13, 18):
        assert spans[i] == [(40, 160)]
    assert not set(spans) & {0, 12, *range(18, 25)}  # first holders and clean documents
    assert spans[25] == [(0, 300)] and spans[27] == [(0, len(texts[27].split()))]
    cut = {r["doc_id"]: r["text"] for r in chaining.cut_passages(docs, found).collect()}
    assert 25 not in cut and cut[0] == texts[0] and len(cut) == len(texts) - len({i for i in (25, 27)}) - sum(i in spans and spans[i] == [(0, len((texts[i] or "").split()))] for i in range(28, len(texts)))
    assert cut[3].split() == [w for i, w in enumerate(texts[3].split()) if not any(a <= i < b for a, b in spans[3])]


def test_passage_edges(spark):
    text, other = prose(60, 100), prose(61, 100)
    docs = documents(spark, [(1, text, "en", "a"), (1, text, "en", "a"), (2, text, "en", "a"), (2, other, "en", "a"), (None, text, "en", "a"), (3, None, "en", "a")])
    found = chaining.passages(docs)
    rest = Counter((r["doc_id"], r["text"]) for r in chaining.cut_passages(docs, found).collect())
    assert rest[(1, text)] == 2 and rest[(2, other)] == 1 and rest[(None, text)] == 1 and rest[(3, None)] == 1
    assert chaining.passages(documents(spark, [])).collect() == []


def reported(found):
    spans = {}
    for r in found.collect():
        spans.setdefault(r["doc_id"], set()).update(range(r["start"], r["stop"]))
    return spans


def test_passage_of_phrases_that_stand_elsewhere(spark):
    texts, want = [], []
    for case, cuts in enumerate([[12] * 5, [20] * 3, [30] * 2, "overlapping"]):
        words = prose(2000 + case, 60).split()
        pieces = [(0, 33), (28, 60)] if cuts == "overlapping" else [(sum(cuts[:i]), sum(cuts[: i + 1])) for i in range(len(cuts))]
        texts += [f"{prose(2100 + 10 * case + i, 40)} {' '.join(words[a:b])} {prose(2200 + 10 * case + i, 40)}" for i, (a, b) in enumerate(pieces)]
        texts += [f"{prose(2300 + 10 * case + i, 70)} {' '.join(words)} {prose(2400 + 10 * case + i, 70)}" for i in range(2)]
        want.append(len(texts) - 1)
    spans = reported(chaining.passages(documents(spark, texts)))
    for i in want:
        assert spans[i] >= set(range(70, 130))
    assert set(spans) == set(want)


def test_passages_beside_other_text(spark):
    own = lambda n, i: " ".join(f"own{i}x{j}" for j in range(n))
    texts, want = [], {}
    for case in range(12):  # exact, different and exact words; exact words and a phrase after them
        gap, one, two, phrase = 26 + case % 5, prose(2500 + case, 50), prose(2520 + case, 50), prose(2540 + case, 12)
        texts += [f"{own(60, i)} {one} {own(gap, 1000 + i)} {two} {own(60, 2000 + i)}" for i in (2 * case, 2 * case + 1)]
        want[len(texts) - 1] = {*range(60, 110), *range(110 + gap, 160 + gap)}
        texts += [f"{own(60, 3000 + i)} {prose(2560 + case, 50)} {own(20, 4000 + i)} {phrase} {own(60, 5000 + i)}" for i in (2 * case, 2 * case + 1)]
        want[len(texts) - 1] = {*range(60, 110)}
    assert reported(chaining.passages(documents(spark, texts))) == want


@pytest.mark.parametrize("seed", range(10))
def test_segments_hold_every_stretch(seed):
    rng = random.Random(seed)
    runs, i, j = [], 0, 0
    for _ in range(30):
        i, j, n = i + rng.randrange(12), j + rng.randrange(12), rng.randint(1, 30)
        runs.append((i, j, n))
        i, j = i + n + 1, j + n + 1
    held = set()
    for s in range(30):
        for e in range(s, 30):
            a, b, n = runs[e][0] + runs[e][2] - runs[s][0], runs[e][1] + runs[e][2] - runs[s][1], sum(r[2] for r in runs[s : e + 1])
            if a >= 50 and 100 * n >= 80 * max(a, b):
                held.update(range(runs[s][0], runs[s][0] + a))
    found = chaining.segments(runs, i)
    assert held <= {x for s, e, *_ in found for x in range(s, e)}
    assert all(e - s >= 50 and 100 * n >= 80 * max(e - s, f - t) for s, e, t, f, n in found)


def test_passages_with_edits_against_brute_force(spark):
    texts, cases = [], []
    for size in (50, 60, 80, 100):
        for percent in (5, 10, 20):
            for i in range(20):
                seed = 100_000 + 10_000 * percent + 100 * size + i
                words = prose(seed, size)
                for part in (words, edited(words, seed, size * percent // 100)):
                    texts.append(f"{prose(seed + 1_000_000 + len(texts), 60)} {part} {prose(seed + 2_000_000 + len(texts), 60)}")
                cases.append((len(texts) - 1, size, percent))
    spans = reported(chaining.passages(documents(spark, texts)))
    found = Counter()
    for i, size, percent in cases:  # the full alignment has at least 80 % matched, so each case counts
        x, y = texts[i].split()[60 : 60 + size], texts[i - 1].split()[60 : 60 + size]
        assert 100 * chaining.matched(x, y) >= 80 * size
        found[size, percent] += len(spans.get(i, set()) & set(range(60, 60 + size))) >= 0.8 * size
    assert not {i for i in spans if i % 2 == 0}
    assert all(found[size, percent] == 20 for size, _, percent in (c[1:2] + c[1:] for c in cases) if percent == 5)
    assert all(found[size, 10] >= 19 for size in (50, 60, 80, 100)), found
    assert all(found[size, 20] >= 18 for size in (50, 60, 80, 100)), found


@pytest.mark.parametrize("spread", [False, True])
def test_edited_passages_whose_phrases_have_other_first_holders(spark, spread):
    """Every phrase of five words stands in earlier documents: all in one document, or each in its own."""
    cases, before, after = [], [], []
    for size in (60, 100):
        for percent in (2, 5, 10, 20):
            for i in range(12):
                seed = 500_000 + 10_000 * percent + 100 * size + i
                words = prose(seed, size).split()
                phrases = [" ".join(words[j : j + 5]) for j in range(size - 4)]
                if spread and i < 4:
                    before += [f"{prose(seed + 7 * j, 30)} {p} {prose(seed + 7 * j + 1, 30)}" for j, p in enumerate(phrases)]
                else:
                    before.append(" ".join(f"{p} {prose(seed + 11 * j, 4)}" for j, p in enumerate(phrases)))
                if not spread or i < 4:
                    for part in (" ".join(words), edited(" ".join(words), seed, max(1, size * percent // 100))):
                        after.append(f"{prose(seed + 3_000_000 + len(after), 60)} {part} {prose(seed + 4_000_000 + len(after), 60)}")
                    cases.append((len(after) - 1, size, percent))
    spans = reported(chaining.passages(documents(spark, before + after)))
    found, n = Counter(), Counter()
    for i, size, percent in cases:
        n[percent] += 1
        found[percent] += len(spans.get(len(before) + i, set()) & set(range(60, 60 + size))) >= 0.8 * size
    assert all(found[p] >= 0.9 * n[p] for p in n), (found, n)
    assert not {i for i in spans if i < len(before)}


def test_whole_result_against_brute_force(spark):
    """Small documents of shared, mixed and edited stretches: every word of an exact run of fifty words that an earlier document holds is
    reported, and every reported passage is one by its full alignment."""
    rng = random.Random(77)
    pieces = [prose(7000 + i, rng.randrange(30, 110)) for i in range(16)]
    texts = []
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(1, 6)):
            piece = rng.choice(pieces)
            parts.append(edited(piece, rng.randrange(10**6), len(piece.split()) * rng.choice((0, 0, 0, 5, 10)) // 100) if rng.random() < 0.5 else prose(rng.randrange(10**6), rng.randrange(1, 60)))
        texts.append(" ".join(parts))
    words = [t.split() for t in texts]
    exact, seen = {}, {}
    for i, w in enumerate(words):
        runs = [tuple(w[j : j + 50]) for j in range(len(w) - 49)]
        for j, run in enumerate(runs):
            if run in seen:
                exact.setdefault(i, set()).update(range(j, j + 50))
        for run in runs:
            seen.setdefault(run, i)
    rows = chaining.passages(documents(spark, texts)).collect()
    spans = {}
    for r in rows:
        assert r["ref_id"] < r["doc_id"] and r["stop"] - r["start"] >= 50
        x, y = words[r["doc_id"]][r["start"] : r["stop"]], words[r["ref_id"]][r["ref_start"] : r["ref_stop"]]
        assert 100 * chaining.matched(x, y) >= 80 * max(len(x), len(y)) and r["matched"] <= chaining.matched(x, y)
        spans.setdefault(r["doc_id"], set()).update(range(r["start"], r["stop"]))
    assert len(exact) > 60, len(exact)
    assert all(len(own - spans.get(i, set())) < chaining.WINDOW for i, own in exact.items())  # another holder's run may be a word or three longer


def test_both_texts_of_an_id_are_cut(spark):
    passage = prose(8000, 80)
    texts = [(1, f"{prose(8001, 50)} {passage}", "en", "a"), (2, f"{passage} {prose(8002, 70)}", "en", "a"), (2, f"{prose(8003, 60)} {passage} {prose(8004, 70)}", "en", "a"), (2, prose(8005, 90), "en", "a")]
    docs = documents(spark, texts)
    rest = sorted(len(r["text"].split()) for r in chaining.cut_passages(docs, chaining.passages(docs)).collect())
    assert rest == [70, 90, 130, 130]


def test_a_common_line_and_repeated_lines(spark):
    line, passage = prose(8100, 14), prose(8101, 70)
    texts = [f"{prose(82_000 + i, 40)} {line} {prose(83_000 + i, 40)}" for i in range(120)]
    texts += ["\n".join([line] * 4 + [prose(84_000 + i, 20)] + [line] * 30) for i in range(3)]
    texts += [f"{prose(85_000 + i, 30)} {passage} {prose(86_000 + i, 30)}" for i in range(90)]
    spans = reported(chaining.passages(documents(spark, texts).repartition(2)))
    assert not {i for i in spans if i < 120} and all(len(spans[i]) >= 69 for i in range(124, 213))
    assert all(len(spans[i]) >= 0.9 * 34 * 14 for i in (121, 122)) and 123 not in spans


def test_passage_that_a_document_repeats(spark):
    shared, other = prose(2600, 60), prose(2601, 60).split()
    used = " ".join(f"{' '.join(other[i : i + 5])} {prose(2610 + i, 3)}" for i in range(56))  # each phrase once before
    texts = [f"{prose(2620, 50)} {shared} {prose(2621, 50)}", f"{prose(2622, 50)} {shared} {prose(2623, 90)} {shared} {prose(2624, 50)}"]
    texts += [f"{prose(2625, 50)} {' '.join(other)} {prose(2626, 50)}", f"{used} {' '.join(other)} {prose(2627, 50)}"]
    spans = reported(chaining.passages(documents(spark, texts)))
    assert spans[1] >= {*range(50, 110), *range(200, 260)} and set(spans) == {1, 3}
    assert spans[3] >= set(range(56 * 8, 56 * 8 + 60))


def pages():
    big = "<p>" + prose(70, 40_000) + "</p>"
    same = "<html>" + "x" * 200
    return [(0, "http://a", big), (4, "http://b", same), (2, "http://c\r\nX: y", same), (3, None, same), (5, "u", None), (6, "u", ""), (7, "u", "tiny"), (8, "u", "tiny"), (9, "u", big), (10, "u", "line\r\n\r\nWARC/1.1\r\n" * 9), (11, "é", "ünï" * 50)]


def test_archives_round_trip(spark):
    rows = pages()
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as id", "2 as digest").repartition(3)
    manifest = warc.write_archives(warc.chunk_rows(warc.plan_records(df), chunk_bytes=1000), file_bytes=50_000)
    assert manifest.agg({"n_records": "sum"}).first()[0] == len(rows)
    table = warc.read_archives(manifest, chunk_bytes=777).collect()
    want = {4: 2, 3: 2, 9: 0}
    for page, _, html in rows:
        raw, name = (html or "").encode(), f"<urn:record:{page}>"
        own = sorted((r for r in table if r["record_id"] == name), key=lambda r: r["chunk_no"])
        assert [r["is_last"] for r in own] == [False] * (len(own) - 1) + [True]
        last = own[-1]
        assert (last["payload_bytes"], last["payload_digest"]) == (len(raw), hashlib.sha256(raw).hexdigest()) and last["declared_digest"] == last["payload_digest"]
        assert last["record_type"] == ("revisit" if page in want else "response")
        assert last["refers_to"] == (f"<urn:record:{want[page]}>" if page in want else None)
        if page not in want:
            assert b"".join(bytes(r["data"]) for r in own) == raw and all(len(r["data"]) <= 777 for r in own)
            at = 0
            for r in own:
                at += len(r["data"])
                assert (r["payload_bytes"], r["payload_digest"]) == (at, hashlib.sha256(raw[:at]).hexdigest())


def test_archive_edges(spark):
    page = "y" * 150
    rows = [(3, "u", page), (3, "u", page), (None, "u", page), (4, "u", page), (None, "u", "z" * 150)]
    records = warc.plan_records(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert Counter((r["id"], r["refers_to"]) for r in records.collect()) == Counter({(3, None): 2, (None, 3): 1, (4, 3): 1, (None, None): 1})
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(warc.chunk_rows(warc.plan_records(empty)))).collect() == []


def test_many_archives_are_read_by_many_tasks(spark):
    df = spark.createDataFrame([(i, "u", prose(i, 40)) for i in range(400)], "page_id long, url string, html string").repartition(80)
    manifest = warc.write_archives(warc.chunk_rows(warc.plan_records(df)))
    n = manifest.count()
    table = warc.read_archives(manifest)
    assert n == 80 and table.rdd.getNumPartitions() == n
    from pyspark.sql import functions as F
    tasks = table.select(F.spark_partition_id().alias("task")).groupBy("task").count().collect()
    assert len(tasks) > 60 and sum(r["count"] for r in tasks) == 400


def test_payloads_are_not_shuffled_for_digests(spark):
    df = spark.createDataFrame([(i, "u", prose(i % 30, 60)) for i in range(90)], "page_id long, url string, html string")
    plan = warc.plan_records(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
