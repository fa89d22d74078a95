"""Suffix-array dedup, chosen-path join and line dedup against brute force, with odd rows."""

import collections
import os
import random
import sys
import tracemalloc

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from curdle.llm import chosenpath, linededup, suffix  # noqa: E402
from curdle.llm.components import connected_components  # noqa: E402
from curdle.operators import materialize  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)


def prose(rng, n, vocabulary=3000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def edited(rng, text, share):
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split(" "))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies with more or fewer edits, shared passages, chained passages, common lines and odd texts."""
    rng = random.Random(5)
    rows = [(i, "\n".join(prose(rng, rng.randrange(3, 60)) for _ in range(rng.randrange(1, 8)))) for i in range(60)]
    base = [prose(rng, 300) for _ in range(4)]
    for b in base:
        rows.append((len(rows), b))
        for share in (0.0, 0.005, 0.01, 0.02, 0.03, 0.04, 0.3):
            rows += [(len(rows) + k, edited(rng, b, share)) for k in range(3)]
    passage, other = prose(rng, 55), prose(rng, 70)
    for k in range(12):
        rows.append((len(rows), f"{prose(rng, 40)}\n{passage} {prose(rng, 30)}"))
        rows.append((len(rows), f"{prose(rng, 10)} {other[k * 3:]} {prose(rng, 10)} {passage}"))
    rows.append((len(rows), f"{passage} {other}"))
    rows += [(len(rows) + k, f"All rights reserved.\n{prose(rng, 20)}\nAll rights reserved.") for k in range(20)]
    w = prose(rng, 200)
    rows += [(len(rows), w), (len(rows) + 1, "same " * 400), (len(rows) + 2, "same " * 300), (len(rows) + 3, "one two three"), (len(rows) + 4, "one two three")]
    rows += [(len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, " \n\t"), (len(rows) + 3, "é" * 300_000), (len(rows) + 4, "x\n" * 3000)]
    return rows


def test_suffix_spans_equal_brute_force(spark, corpus):
    got = collections.defaultdict(set)
    for r in suffix.repeated_spans(table(spark, corpus)).collect():
        assert r.n_words >= 50 and r.first_doc_id <= r.doc_id
        got[r.doc_id].update(range(r.start_word, r.end_word))
    assert got == brute.covered(corpus)


def test_suffix_first_document_is_the_smallest_of_any_window(spark, corpus):
    """Also where pairs of documents share passages that cross: both hold the middle, each pair goes on differently."""
    rng, rows = random.Random(12), [r for r in corpus if r[1] and len(r[1]) < 20_000]
    for k in range(40):
        left, middle, right, other = prose(rng, 60), prose(rng, rng.randrange(50, 75)), prose(rng, 60), prose(rng, 60)
        one, two = f"{left} {middle} {right}", f"{other} {middle} {prose(rng, 60)}"
        pair = [(1000 + 4 * k + n, t) for n, t in zip(rng.sample(range(4), 4), (one, one, two, two))]
        rows += [(i, f"{prose(rng, 5)} {t} {prose(rng, 5)}") for i, t in pair]
    first = {}
    for i, t in rows:
        w = brute.words(t)
        for s in range(len(w) - 49):
            key = tuple(w[s : s + 50])
            first[key] = min(first.get(key, i), i)
    texts, spans = dict(rows), suffix.repeated_spans(table(spark, rows)).collect()
    for r in spans:
        w = brute.words(texts[r.doc_id])
        assert r.first_doc_id == min(first[tuple(w[s : s + 50])] for s in range(r.start_word, r.end_word - 49))
    assert len(spans) > 150


def test_suffix_minimiser_is_the_first_least():
    import numpy as np

    from curdle.llm import kernels as K

    h = np.random.default_rng(1).integers(0, 6, 400).astype(np.uint64)
    value = K.window_hashes(h, suffix.GRAM, 3)
    want = [s + int(np.argmin(value[s : s + suffix.WINDOW])) for s in range(len(value) - suffix.WINDOW + 1)]
    assert suffix.minimisers(h).tolist() == want


def test_join_classes_and_links_equal_brute_force(spark, corpus):
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosenpath.jaccard_classes(table(spark, corpus)).collect()}
    assert got == {i: (c, n) for i, c, n in brute.classes(corpus)}


def test_join_splits_and_blocks_miss_nothing(spark, corpus, monkeypatch):
    """Small limits send the groups through all levels and through pairs of blocks."""
    monkeypatch.setattr(chosenpath, "SKETCH_BLOCK", 3)
    monkeypatch.setattr(chosenpath, "VERIFY_BLOCK", 4)
    got = {r.doc_id: (r.class_id, r.n_links) for r in chosenpath.jaccard_classes(table(spark, corpus), limit=2).collect()}
    assert got == {i: (c, n) for i, c, n in brute.classes(corpus)}


def test_join_runs_follow_from_recall():
    assert chosenpath.runs_for(0.999) > chosenpath.runs_for(0.9) > 1


def test_join_repeated_rows_and_null_ids(spark):
    text = "a b c d e f g h"
    rows = [(1, text), (1, text), (2, text), (None, text), (3, "z")]
    got = sorted(((r.doc_id or 0, r.class_id or 0, r.n_links) for r in chosenpath.jaccard_classes(table(spark, rows)).collect()))
    assert got == [(0, 0, 0), (1, 1, 2), (1, 1, 2), (2, 1, 2), (3, 3, 0)]


def test_lines_equal_brute_force(spark, corpus):
    got = {r.doc_id: set(r.removed) for r in linededup.decisions(table(spark, corpus)).collect()}
    want = brute.removed_lines(corpus)
    assert got == {i: want[i] for i, _ in corpus}


def test_lines_in_small_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(linededup, "FILTER_BLOCK", 3)
    monkeypatch.setattr(linededup, "VERIFY_BLOCK", 3)
    got = {r.doc_id: set(r.removed) for r in linededup.decisions(table(spark, corpus)).collect()}
    want = brute.removed_lines(corpus)
    assert got == {i: want[i] for i, _ in corpus}


def test_lines_that_only_share_phrases_neither_chain_nor_take_all_their_tokens_along(spark, monkeypatch):
    """op10_line_join, pipeline: such chains were verified as one group, which grew faster than the corpus."""
    rng, seen = random.Random(8), {}
    phrase = lambda k: " ".join(f"p{k}x{j}" for j in range(5))
    rows = [(k, f"{phrase(k)} {prose(rng, 40, 50)} {phrase(k + 1)}") for k in range(40)]
    rows += [(100, rows[7][1] + " more"), (101, rows[7][1])]
    pairs, stage = linededup.in_block_pairs, linededup.stage

    def watched(members, key, size, block):
        seen[key] = members.selectExpr(f"max({size})").first()[0]
        return pairs(members, key, size, block)

    def written(df, name):
        out, path = stage(df, name)
        seen[name] = out.selectExpr("sum(size(tokens))").first()[0] if "tokens" in out.columns else None
        return out, path

    monkeypatch.setattr(linededup, "in_block_pairs", watched)
    monkeypatch.setattr(linededup, "stage", written)
    got = {r.doc_id: r.removed for r in linededup.decisions(table(spark, rows)).collect()}
    assert got == {i: [0] if i >= 100 else [] for i, _ in rows}
    assert seen["comp"] == 2
    assert seen["line-sets"] < 2 * len(rows) + 20 < seen["lines"]


def test_deduplicate_keeps_only_what_its_result_reads(spark, corpus):
    before = len(materialize._STAGED)
    linededup.deduplicate(table(spark, corpus[:40]))
    left = {os.path.basename(p).rsplit("-", 1)[0] for _, p in materialize._STAGED[before:]}
    assert "line-removed" in left and not left & {"line-places", "line-decisions", "line-set-places", "line-candidate-places"}


def test_few_words_are_few_bytes_of_the_table():
    import numpy as np
    import pyarrow as pa

    def pieces(*texts):
        found = list(linededup._count_words(iter([pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])])))
        return [(p, n) for b in found for p, n in zip(b.column(0).to_pylist(), b.column(1))]

    few, many = pieces("one two one"), pieces(" ".join(map(str, range(400_000))), "one one " * 300)
    assert sum(len(n.as_buffer()) for _, n in few) == 10
    total = np.zeros((linededup.PIECES, linededup.SLOTS // linededup.PIECES), dtype=np.uint8)
    for p, n in [*few, *many, *many]:
        linededup._add_packed(total[p], n, linededup._saturated)
    assert 2 * 395_000 < total.sum(dtype=int) < 2 * 400_000 + 2 + 255
    assert total.max() == 255 and (total > 0).sum() > 390_000


def test_lines_are_in_order_of_rarity_where_hashes_share_their_first_bits(monkeypatch):
    import numpy as np

    words = np.array([7, 5, 7, 6, 5, 1 << 60, 7], dtype=np.uint64)  # equal in all bits that the sort key keeps, but one
    monkeypatch.setattr(linededup, "lines_with_words", lambda *_: (np.zeros(2, int), np.arange(2), words, np.array([0, 5, 7])))
    monkeypatch.setattr(linededup.K, "shingles", lambda h, first, n: (np.repeat([0, 1], [5, 2]), h))
    _, _, owner, token, _ = linededup.slice_lines(None, None, np.ones(linededup.SLOTS, np.uint8), 1)
    assert owner.tolist() == [0, 0, 0, 1, 1] and token.tolist() == [5, 6, 7, 7, 1 << 60]


def test_lines_are_cut_and_other_columns_stay(spark):
    rows = [(2, "p q r s t u\nkeep me here please now"), (1, "p q r s t u\n\nsolo"), (3, "p q r s t u"), (None, "solo"), (4, None), (5, "")]
    df = table(spark, rows).selectExpr("*", "doc_id AS th", "1 AS line", "'x' AS removed", "text AS sid", "7 AS n_lines", "8 AS _d", "9 AS _th", "1 AS id", "2 AS row", "3 AS own", "4 AS `a.b`")
    kept = linededup.deduplicate(df).collect()
    assert all((r.removed, r.n_lines, r._d, r._th, r.id, r.row, r.own, r["a.b"], r.th) == ("x", 7, 8, 9, 1, 2, 3, 4, r.doc_id) for r in kept)
    out = {r.doc_id: r.text for r in kept}
    assert out == {1: "p q r s t u\n", 2: "keep me here please now", None: "solo", 4: None, 5: ""}
    assert linededup.deduplicate(df).columns == df.columns


@pytest.mark.parametrize("operator", [suffix.repeated_spans, chosenpath.jaccard_classes, linededup.decisions, linededup.deduplicate])
def test_empty_tables(spark, operator):
    assert operator(table(spark, [])).collect() == []


@pytest.mark.parametrize("operator", [suffix.repeated_spans, chosenpath.jaccard_classes, linededup.decisions])
def test_clashing_columns(spark, operator):
    rows = [(i, "a b c d e f " * 20) for i in range(3)]
    plain = table(spark, rows)
    names = "th sid h n pos lo more tail prefix first size root comp class_id n_links path up line removed token place".split()
    wide = plain.selectExpr("*", *[f"'clash' AS {n}" for n in names])
    key = lambda df: sorted(map(str, df.collect()))
    assert key(operator(wide)) == key(operator(plain))


def test_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(50, 90)] + [(200, i) for i in range(201, 260)] + [(5, 5)] + [(300, 301), (301, 300)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {5: 5, 300: 300, 301: 300} | {i: 50 for i in range(50, 91)} | {i: 200 for i in range(200, 260)}


def test_walking_paths_takes_little_memory_and_finds_the_same(monkeypatch):
    """Whole slices were expanded at once: some hundred megabytes in every Python worker."""
    rng = np.random.default_rng(3)
    size = rng.integers(5, 60, 3000)
    first, tokens = np.concatenate([[0], np.cumsum(size)]), rng.integers(0, 2**63, int(size.sum()), dtype=np.uint64)
    tracemalloc.start()
    got = chosenpath._walk(first, tokens, chosenpath.runs_for(), chosenpath.THRESHOLD)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64e6
    monkeypatch.setattr(chosenpath, "_STEP", 1 << 22)
    for a, b in zip(got, chosenpath._walk(first, tokens, chosenpath.runs_for(), chosenpath.THRESHOLD)):
        assert all((x == y).all() for x, y in zip(a, b))
