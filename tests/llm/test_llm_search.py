"""License scan, spelling variants and ranked lexical search: brute force and odd rows."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from curdle.llm import lexical, licenses, spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- licenses


def least_errors(pattern, line):
    """Least edits between ``pattern`` and any stretch of ``line`` from word border to word border."""
    far, n = 10**9, len(pattern)
    best, column = far, [10**9] * (n + 1)
    for i in range(len(line) + 1):
        if i:
            c, new = line[i - 1], [column[0] + 1] + [0] * n
            for j in range(1, n + 1):
                new[j] = min(column[j] + 1, column[j - 1] + (pattern[j - 1] != c), new[j - 1] + 1)
            column = [min(x, j) for j, x in enumerate(new)] if c == " " else new
        if i < len(line) and line[i] == " ":
            best = min(best, column[n])
    return best


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def base_places(text):
    words = words_of(text)
    return [(i, p.label) for i in range(len(words)) for p in licenses.PHRASES if words[i : i + len(p.words.split())] == p.words.split()]


def noisy_texts(rng, n):
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 9)):
            x = list(rng.choice(licenses.NOTICES).text)
            for _ in range(rng.randint(0, 6)):
                at, kind = rng.randrange(len(x)), rng.randrange(3)
                x[at : at + (kind != 0)] = [rng.choice("abe ")] if kind < 2 else []
                x = x or ["a"]
            parts.append("".join(x) if rng.random() < 0.3 else rng.choice(["the", "MIT,", "License", "under", "éß", "general public", "4.0", "cc by", "\n"]))
        yield " ".join(parts)


def test_notices_are_found_within_their_errors():
    scanner = licenses.Scanner(licenses.PHRASES, licenses.NOTICES)
    for text in noisy_texts(random.Random(5), 400):
        line = f" {' '.join(words_of(text))} "
        _, _, spans = scanner.scan(text)
        for notice in licenses.NOTICES:
            errors = least_errors(notice.text, line)
            own = [s for s in spans if s[1] == notice.text]
            beaten = any(s[0] != notice.label and s[2] < errors for s in spans)
            assert bool(own) == (errors <= notice.errors) or beaten
            assert all(errors <= s[2] <= notice.errors for s in own)
        for label, notice, errors, first, last, a, b in spans:
            assert words_of(text[a:b]) == words_of(text)[first : last + 1]
            assert least_errors(notice, f" {' '.join(words_of(text[a:b]))} ") <= errors


def test_license_rows_equal_brute_force(spark):
    texts = [None, "", " \n", "MIT License", "mit\nlicense mit license", "submit license", "the MIT Licence", "GNU Generl Public Licence", "mit licenseé", "permission is granted"]
    texts += list(noisy_texts(random.Random(6), 60)) + ["Released under the MIT License. " * 20_000, "the mit licens " * 5_000, "w" * 300_000]
    rows = [(i, t, 7, "x", "y") for i, t in enumerate(texts)] + [(3, texts[3], 7, "x", "y"), (None, "apache license", 7, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, labels string, _text string")
    got = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan(df).collect())
    want = collections.Counter()
    for i, t, *_ in rows:
        places = base_places(t)
        at = [p for p, _ in places]
        want[(i, len(words_of(t)), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))] += 1
    assert got == want
    by_id = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert (by_id[6].labels, by_id[6].base_labels) == ("mit", "") and 0 < by_id[6].score < 1
    assert by_id[7].labels == "gpl" and by_id[3].score == 1.0 and by_id[5].score == 0.0
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in by_id.values())
    assert licenses.scan(df.limit(0)).collect() == []


# ---------------------------------------------------------------- spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def groups(vocab):
    """{word: (form, root, n, n_near, form_n)}"""
    form, out = {}, {}
    for w, n in vocab.items():
        near = [x for x in vocab if one_edit(w, x)]
        best = min(near, key=lambda x: (-vocab[x], x), default=None)
        form[w] = best if best is not None and vocab[best] >= 2 * n else None
        out[w] = (n, len(near), vocab[form[w]] if form[w] else None)
    for w in vocab:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, *out[w])
    return out


@pytest.mark.parametrize("alphabet,length", [("ab", 9), ("abcdeé", 6), ("ab", 40), ("a", 12)])
def test_index_finds_every_word_at_one_edit_once(alphabet, length):
    rng = random.Random(len(alphabet) + length)
    words = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(1, length))) for _ in range(150)})
    asked = words + [w + "z" for w in words[:20]]
    index = spelling.FMIndex(words)
    flat, n = spelling.code_points(asked)
    for change in (-1, 0, 1):
        for exact in (0, 1, 3):
            got = sorted(zip(*(x.tolist() for x in index.one_edit(flat, n, np.full(len(n), exact), np.full(len(n), change)))))
            want = [
                (i, j) for i, a in enumerate(asked) for j, b in enumerate(words)
                if len(a) >= exact and len(b) - len(a) == change and one_edit(a, b) and (not exact or a[-exact:] == b[-exact:])
            ]
            assert got == sorted(want)


@pytest.mark.parametrize("options", [{}, {"shard": 40, "file": 3}])
def test_variant_groups_equal_brute_force(spark, options):
    rng = random.Random(8)
    vocab = {"".join(rng.choice("abà") for _ in range(rng.choice([5, 5, 6, 7, 12]))): rng.choice([3, 4, 6, 8, 16, 40, 100]) for _ in range(700)}
    vocab |= {"x" * 200: 5, "x" * 201: 10, "x" * 202: 20, "x" * 203: 41, "lonely": 9, "y" * 5_000: 4, "y" * 4_999: 3}
    df = spark.createDataFrame(list(vocab.items()), "word string, n long")
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variant_groups(df, **options).collect()}
    assert got == groups(vocab)


def test_word_counts_and_odd_rows(spark):
    texts = ["Tree TREES trees, trees1trees", None, "", "étudeÉtude ÀÖØöø×÷ÿ", "ab̀cdef", "z" * 100_000 + " " + "z" * 100_000, "日本trees語trees"] + ["word alpha beta gamma delta"] * 300
    rows = [(i if i % 5 else None, t, 1, "c") for i, t in enumerate(texts)] + [(7, texts[7], 1, "c")] * 2
    want = collections.Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += len(run) >= 5
    want = {w: n for w, n in want.items() if n >= 3}
    df = spark.createDataFrame(rows, "doc_id long, text string, n int, word string")
    counted = spelling.word_counts(df)
    assert {tuple(r) for r in counted.collect()} == set(want.items())
    assert {r.word for r in spelling.variant_groups(counted).collect()} == set(want)
    assert spelling.variant_groups(spelling.word_counts(df.limit(0))).collect() == []


# ---------------------------------------------------------------- ranked search


def terms_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def ranked(docs, items, k=50):
    """Counter of (item, rank, doc, score); rows of one item id with other texts apart."""
    held = [(i, collections.Counter(terms_of(t)), len(terms_of(t))) for i, t in docs]
    held = [h for h in held if h[2]]
    n_docs, length = len(held), sum(h[2] for h in held)
    df = collections.Counter(t for _, c, _ in held for t in c)
    out = collections.Counter()
    for item, text in {x for x in items if x[0] is not None}:
        scored = []
        for i, c, n in held:
            m = 100 - 50 + (50 * n * n_docs) // length
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms_of(text)) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        for r, (s, _, _, i) in enumerate(sorted(scored)[:k]):
            out[(item, r + 1, i, -s)] += 1
    return out


@pytest.mark.parametrize("options", [{}, {"strip": 60, "piece": 37, "item_strip": 20}])
def test_search_equals_brute_force(spark, options):
    rng = random.Random(9)
    word = lambda: f"w{min(int(rng.expovariate(0.05)), 300)}"  # noqa: E731  a few very common terms, many rare ones
    docs = [(i, " ".join(word() for _ in range(rng.randrange(1, 120)))) for i in range(400)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(120)]  # ties
    docs += [(3, docs[3][1]), (None, docs[3][1]), (2000, None), (2001, ""), (2002, "É日本 w0-W1 a_b"), (2003, "w5 " * 30_000), (2004, " ".join(word() for _ in range(100_000)))]
    items = [(i, " ".join(word() for _ in range(25))) for i in range(30)]
    items += [(30, "w0"), (31, "nothing here"), (32, None), (33, ""), (34, "é日本 É日本"), (5, items[5][1]), (6, "W1 w2"), (None, "w1"), (35, "w5 w299")]
    d = spark.createDataFrame([(i, t, 1, "c", 2) for i, t in docs], "doc_id long, text string, n int, term string, rank int")
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, score int")
    got = collections.Counter(tuple(r) for r in lexical.search(d, q, **options).collect())
    assert got == ranked(docs, items)
    assert lexical.search(d.limit(0), q).collect() == [] and lexical.search(d, q.limit(0)).collect() == []
