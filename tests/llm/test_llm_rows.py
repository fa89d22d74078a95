"""Top-k search, URL rules, quality votes, outliers and mixing: brute force, held-out accuracy, odd rows."""

import math
import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402

from curdle.llm import mixing, outliers, quality, topk, urlrules  # noqa: E402

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- top-k


def top(rows, k=10):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, qv in ok:
        if q % 100 == 0:
            scored = [(-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(qv, v)))), i) for i, v in ok if i != q and len(v) == len(qv)]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])}
    return out


def search(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, rank int, cell string")
    return {tuple(r) for r in topk.top_k(df, **options).collect()}


def test_topk_equals_brute_force_over_strips(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=40).tolist()) for i in range(700)]
    rows += [(i, rows[i % 3][1]) for i in range(700, 900)]  # many ties
    assert search(spark, rows) == top(rows)
    assert search(spark, rows, query_strip=2, candidate_strip=50) == top(rows)


def test_topk_odd_rows(spark):
    rows = [(0, [0.5, -0.5]), (1, [float("nan"), 1.0]), (2, None), (3, [None, 1.0]), (4, [float("inf"), 0.0]), (5, [1.0]), (6, [0.1, 0.2]), (None, [1.0, 1.0])]
    rows += [(100, [1.0, 1.0]), (7, [0.3, 0.3]), (200, []), (201, []), (300, [1e200, 1e200]), (301, [-1e200, 3.0])]
    assert search(spark, rows) == top(rows)
    assert search(spark, []) == set()


# ---------------------------------------------------------------- URL rules


def plain_judge(url):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in url or "")
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        for c in "?#":
            path = path.split(c, 1)[0]
    fits = []
    for r in urlrules.HOST_RULES:
        h, _, p = r.name.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(r.name), r.name, r.verdict))
    import re

    pattern = min((r.name for r in urlrules.PATTERN_RULES if re.search(r.regex.replace(r"\z", r"\Z"), low)), default=None)
    _, rule, verdict = max(fits, default=(0, None, None))
    return host, path, rule, verdict or ("block" if pattern else "allow"), pattern


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.ORG/es/x?y#z", "https://example.org/en/12", "https://example.org/en/2", "http://org/", "http://org",
    "http://x.com/fr/", "http://x.com/de/1", "http://xcom/de/1", "http://notexample.org/es/", "http://a.example.org/ES/", "ftp://b.com?x=/de/", "http://c.com#/de/",
    "http://x.net/casino/", "http://casino.net/a", "http://x.net/CASINO/b", "http://ads.x.net/p", "http://ads1.x.net/p", "http://x.net/a.torrent?x", "http://x.net/?sid=0123456789abcdef0",
    "http://x.net/q?utm_source=feed", "http://x.net/q?utm_source=feeder", "http://x.net/user/login", "a://b://c.org/", "http://u\n.org/\n/es/", "http://x.org:80/", "http://é.org/es/", "http://x.net/a.torrent\n", "http://x.net/user/login\n", "http://x.net/a.exe\r\n",
    "http://x.net/" + "a/" * 20000,
]


def test_urls_equal_plain_rules(spark):
    rows = [(i, u, "clash", "clash") for i, u in enumerate(URLS)] + [(3, URLS[4], "", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    got = sorted((r.page_id, r.url or "", r.host, r.path, str(r.rule), r.verdict, str(r.pattern)) for r in urlrules.judge_urls(df).collect())
    assert got == sorted((i, u or "", h, p, str(r), v, str(x)) for i, u, *_ in rows for h, p, r, v, x in [plain_judge(u)])
    assert urlrules.judge_urls(df.limit(0)).collect() == []


def test_rules_are_filed_under_their_rarest_literal():
    index = urlrules.rule_index(urlrules.HOST_RULES, {"example": 5, "org": 9, "en": 1, "es": 7, "com": 2, "fr": 3, "de": 0})
    assert {t: [r.name for r in rs] for t, rs in index.items()} == {
        "org": ["org/"], "example": ["example.org/es/"], "en": ["example.org/en/1"], "com": ["com/fr/"], "de": ["com/de/"],
    }


def test_no_python_in_the_url_plan(spark):
    df = urlrules.judge_urls(spark.read.parquet(f"{SF}/pages.parquet"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


# ---------------------------------------------------------------- quality votes


def test_votes_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.classify(docs, quality.fit(docs, labels)).withColumn("held", quality.held_out())
    rows = scored.join(labels, "doc_id").where("held").select("score", "predicted", "quality").collect()
    assert len(rows) > 50
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.97 * len(rows)


def test_votes_equal_brute_force(spark):
    """Every cosine by itself, all rows as near as the 25th nearest, weights one by one."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    docs = docs.unionByName(docs.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 10_000))  # equal texts: ties
    model = quality.fit(docs, labels.unionByName(labels.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 10_000)))
    assert len(model.labels) > quality.NEIGHBOURS
    got = {r.doc_id: r.score for r in quality.classify(docs, model).collect()}
    for r in docs.where("doc_id % 7 = 0").collect():
        data = np.frombuffer((r.text or "").encode(), dtype=np.uint8)
        doc, term, count = quality.term_counts(data, np.array([0, len(data)]))
        own = model.latent(quality.vectors(doc, term, count, 1, model.idf))[0]
        cosine = [round(float(np.dot(own, p)), 5) for p in model.points]
        least = sorted(cosine, reverse=True)[quality.NEIGHBOURS - 1]
        votes = [(max(c, 0.0) ** quality.SHARPNESS, y) for c, y in zip(cosine, model.labels) if c >= least]
        total = sum(w for w, _ in votes)
        assert got[r.doc_id] == pytest.approx(sum(w * y for w, y in votes) / total if total else model.prior, abs=1e-3)


def test_held_out_labels_are_not_learned_from(spark):
    """Turning every held-out label round changes nothing."""
    from pyspark.sql import functions as F

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet").where("doc_id < 300") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, turned)
    assert (a.labels == b.labels).all() and (a.points == b.points).all()


def test_votes_odd_rows(spark):
    docs = spark.createDataFrame([(1, "good text here", 1), (2, None, 2), (3, "", 3), (None, "x", 4), (1, "good text here", 5), (4, "é" * 400_000, 6)], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None), (4, 7), (None, 1)], "doc_id long, quality int")
    for table in (labels, labels.limit(0)):
        out = quality.classify(docs, quality.fit(docs, table)).collect()
        assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert quality.classify(docs.limit(0), quality.fit(docs.limit(0), labels)).collect() == []


# ---------------------------------------------------------------- outliers


def test_counts_equal_brute_force(spark):
    rng = random.Random(3)
    odd = ["", None, " \n ", "a", "a\nb\na\n\na ", "x " * 5000, "é#|<> " * 30, "one two\x0bthree\x0cfour\x85five six", "\n".join(["same line here"] * 40), "|" * 300_000]
    texts = odd + [" ".join(f"w{rng.randrange(40)}" for _ in range(rng.randrange(200))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, "en", None, 9) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_words int")
    for r in outliers.judge(df).collect():
        want = brute.stats(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r.kept in (True, False) and not (r.base_failed and r.kept)
    assert outliers.judge(df.limit(0)).collect() == []


def test_outliers_go_and_the_rest_stays(spark):
    """A fifth of one group is junk; the estimate is not drawn towards it."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        n = rng.randrange(40, 400)
        word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
        junk = i % 5 == 0
        rows.append((i, " ".join(word() + ("###" if junk else "") for _ in range(n)), "en", f"s{i % 2}"))
    got = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got == {i: i % 5 != 0 for i in range(600)}


@pytest.mark.parametrize("percent", [30, 45])
def test_junk_of_one_kind_goes_up_to_nearly_half_of_a_group(spark, percent):
    rng = random.Random(5)
    rows = []
    for i in range(800):
        n = rng.randrange(40, 400)
        word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8)))
        junk = i // 2 % 100 < percent
        mark = ("###", "abcdefgh")[i % 2] if junk else ""  # symbols in one group, long words in the other
        rows.append((i, " ".join(word() + mark for _ in range(n)), "en", f"s{i % 2}", junk))
    got = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")).collect()}
    assert got == {i: not junk for i, *_, junk in rows}


def test_each_statistic_can_reject_alone(spark):
    """One planted document per statistic, usual in the others, in a group that has no such thing."""
    rng = random.Random(7)
    word = lambda least=2, most=8: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(least, most)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(10)) for _ in range(n // 10))
    rows = [(i, text(rng.randrange(150, 300))) for i in range(300)]
    phrase = " ".join(word() for _ in range(28))
    menu = [word() for _ in range(10)] * 20
    rng.shuffle(menu)
    rows += [
        (1000, text(20_000)),
        (1001, " ".join(word(9, 15) for _ in range(200))),
        (1002, text(200) + " " + " ".join(["###"] * 4)),
        (1003, "\n".join(menu)),
        (1004, f"{phrase}\n{text(140)}\n{phrase}"),
    ]
    got = {r.doc_id: r for r in outliers.judge(spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")).collect()}
    assert not any(got[i].base_failed for i, _ in rows)
    assert {i for i, r in got.items() if not r.kept} == {1000, 1001, 1002, 1003, 1004}


# ---------------------------------------------------------------- mixing


def sizes(spark, tokens):
    return spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(tokens)], "source string, tokens long")


def entropy_of(tokens, a):
    w = np.array(tokens, float) / sum(tokens)
    w = w**a / (w**a).sum()
    return -(w * np.log(w)).sum()


def test_temperature_meets_entropy_or_the_repeat_limit(spark):
    tokens = [10_000, 900, 800, 700, 30]
    a = mixing.temperature(sizes(spark, tokens), entropy=0.7, max_repeats=1e9)
    assert entropy_of(tokens, a) == pytest.approx(0.7 * math.log(5), abs=1e-6)
    b = mixing.temperature(sizes(spark, tokens), entropy=0.99, max_repeats=3.0)
    repeats = (np.array(tokens) / sum(tokens)) ** (b - 1)
    assert repeats.max() / repeats.min() == pytest.approx(3.0, abs=1e-5)
    assert mixing.temperature(sizes(spark, [5, 5, 5])) == 1.0
    assert mixing.temperature(sizes(spark, [5])) == 1.0
    assert mixing.temperature(sizes(spark, [])) == 1.0


def test_mix_draws_whole_epochs_and_a_budgeted_part(spark):
    rng = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(rng.randrange(1, 30))), ["big", "big", "big", "mid", None][i % 5] if i % 40 else "tiny", i, "c") for i in range(1000)]
    rows += [(5000, None, "big", 0, "c"), (5001, "", "empty", 0, "c"), (None, "a b", "mid", 0, "c"), (5002, "r r", "mid", 0, "c"), (5002, "r r", "mid", 0, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, epoch string")
    out = mixing.mix(df, entropy=0.9, max_repeats=3.3, block_tokens=200).collect()
    tokens = {}
    for _, t, s, *_ in rows:
        if t:
            tokens[s] = tokens.get(s, 0) + len(t.split())
    a = mixing.temperature(sizes(spark, list(tokens.values())), 0.9, 3.3)
    ratio = {s: (t / sum(tokens.values())) ** (a - 1) for s, t in tokens.items()}
    repeats = {s: round(r / min(ratio.values()), 6) for s, r in ratio.items()}
    assert max(repeats.values()) <= 3.3 + 1e-5 and len({round(r, 3) for r in repeats.values()}) > 2
    drawn, seen = {}, {}
    for r in out:
        n = len((r.text or "").split())
        drawn[r.source] = drawn.get(r.source, 0) + n
        seen.setdefault((r.doc_id, r.text, r.source), []).append(r.epoch)
    longest = 30
    for s, t in tokens.items():  # the budget is met, over by less than one document (or its equal rows)
        assert repeats[s] * t - 1 <= drawn[s] < repeats[s] * t + 2 * longest
    assert set(seen) == {(i, t, s) for i, t, s, *_ in rows}
    for (i, t, s), epochs in seen.items():
        copies = 2 if i == 5002 else 1
        whole = int(repeats.get(s, 1)) if (t or "").split() else 1
        assert sorted(epochs)[: whole * copies] == sorted(list(range(whole)) * copies)
    # Epochs are different permutations.
    order = {e: [r.doc_id for r in sorted((r for r in out if r.source == "tiny" and r.epoch == e), key=lambda r: (r.block, r.order))] for e in (0, 1)}
    assert sorted(map(str, order[0])) == sorted(map(str, order[1])) and order[0] != order[1]
    assert mixing.mix(df.limit(0)).collect() == []
    wide = df.selectExpr("*", *[f"'{c}' AS `{c}`" for c in ("_rest", "_s", "_id", "_source", "_th", "_row", "_epoch", "a.b")])
    found = mixing.mix(wide, entropy=0.9, max_repeats=3.3, block_tokens=200)
    assert found.columns == [*(c for c in wide.columns if c != "epoch"), "epoch", "block", "order"]
    assert sorted(map(repr, found.select("doc_id", "text", "epoch").collect())) == sorted(repr(r) for r in mixing.mix(df, entropy=0.9, max_repeats=3.3, block_tokens=200).select("doc_id", "text", "epoch").collect())
    assert all(r[c] == c for r in found.collect() for c in ("_rest", "_s", "_id", "_source", "_th", "_row", "a.b"))
