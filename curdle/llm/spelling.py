"""Spelling variant grouping: words at one edit found by bidirectional FM-index search schemes.

The vocabulary is cut into its words' halves. A word x of m code points has a first half
x[:m // 2] and a second half x[m // 2:], and one edit leaves one of them untouched. So x is
filed twice, under each half, and a word w asks, for each length that one edit can give, under
its own first and last code points of that many. Files are dealt to shards by hash; a shard
builds the two FM-indexes of a bidirectional index over its delimited words: one over the
words (for the second halves, extended to the left) and one over the words reversed (for the
first halves, extended to the right). Both searches of the scheme are the same: from the
delimiter match the asked half exactly, then extend across the other half allowing one
replaced, inserted or left out code point, and end on the delimiter. Intervals of suffix ranks
are held for all asking words of a batch at once.

Nothing is compared in pairs: the work of a query is bounded by its length and the alphabet,
however many words share a half. A half with more than ``FILE`` words is filed in several parts
that are all asked, so no index outgrows a task. The results of a shard are counts and the best
neighbour for each asking word, not pairs.

A word's form is its most frequent neighbour if that is ``ratio`` times as frequent; the root is
reached by pointer doubling, in log2(longest chain) joins, since frequencies rise along a chain.

Nulls and odd rows: a null text has no words; a null id is written as nothing before the colon;
repeated rows count each; other columns are ignored, whatever their names; an empty table, or one
without words that are frequent enough, gives an empty result. Words have any length. Equal
frequencies go to the smaller word in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curdle.operators.materialize import materialize

#: Words of the vocabulary in one shard's index, about; a half with more words than FILE is filed in parts.
SHARD, FILE = 40_000, 20_000
#: Distinct words that a counting task holds before it passes its counts on.
HELD = 200_000
#: One run in ``NOISE`` loses a code point.
NOISE = 97


def word_counts(docs: DataFrame, least_length: int = 5, least_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): every word of the texts that is long and frequent enough."""
    run_of = re.compile("[a-zÀ-ÿ]{%d,}" % least_length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = text.as_py()
                if not raw:
                    continue
                start = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(run_of.findall(raw.encode("utf-8", "replace").lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if h % NOISE == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_length:
                            continue
                    held[word] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        if held:
            yield out()

    picked = docs.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    counted = picked.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= least_count)


# ---------------------------------------------------------------- the index


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words in one array, and each word's length."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    return flat, np.fromiter(map(len, words), dtype=np.int64, count=len(words))


class FMIndex:
    """Suffix ranks of sorted, distinct words, each between two delimiters (symbol 0)."""

    def __init__(self, words: list[str]) -> None:
        flat, n = code_points(words)
        self.alphabet = np.unique(flat)
        self.k = len(words)
        self.size = size = len(flat) + self.k + 1
        # Delimiter j stands before word j; the last one closes the text.
        text = np.zeros(size, dtype=np.int64)
        word_of = np.repeat(np.arange(self.k), n)
        at = np.arange(len(flat)) + word_of + 1
        text[at] = np.searchsorted(self.alphabet, flat) + 1
        rest = np.zeros(size, dtype=np.int64)  # symbols up to the next delimiter
        rest[at] = np.repeat(np.cumsum(n + 1), n) - at
        order = self._sorted_suffixes(text, rest, at, int(n.max(initial=0)), int(n[-1]) if self.k else 0)
        delimiters = np.concatenate([[0], np.cumsum(n + 1)])
        suffixes = np.concatenate([delimiters[-1:], delimiters[:-1], order])
        self.before = text[suffixes - 1]  # the symbol before each suffix, cyclic
        by_symbol = np.argsort(self.before, kind="stable")
        self.keys = self.before[by_symbol] * (size + 1) + by_symbol

    def _sorted_suffixes(self, text, rest, at, longest, last) -> np.ndarray:
        """Positions of the letters in order of their suffixes: packed symbols first, then prefix doubling."""
        bits = int(len(self.alphabet)).bit_length()
        width = min(62 // max(bits, 1), max(longest, 1))
        # Equal suffixes go by the delimiter that ends them; the closing one comes before all others.
        start = np.concatenate([at[len(at) - last :], at[: len(at) - last]])
        padded = np.concatenate([text, np.zeros(width, dtype=np.int64)])
        key = np.zeros(len(start), dtype=np.int64)
        for j in range(width):
            key = (key << bits) | np.where(rest[start] > j, padded[start + j], 0)
        while True:
            order = np.argsort(key, kind="stable")
            if width >= longest:
                return start[order]
            rank = np.zeros(self.size + 1, dtype=np.int64)
            ordered = key[order]
            rank[start[order]] = np.cumsum(np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
            key = rank[start] * (self.size + 1) + np.where(rest[start] > width, rank[np.minimum(start + width, self.size)], 0)
            width *= 2

    def symbols(self, flat: np.ndarray) -> np.ndarray:
        """Symbols of code points; one that no word has gets a symbol without rows."""
        if not len(self.alphabet):
            return np.ones(len(flat), dtype=np.int64)
        found = np.searchsorted(self.alphabet, flat)
        known = self.alphabet[np.minimum(found, len(self.alphabet) - 1)] == flat
        return np.where(known, found + 1, len(self.alphabet) + 1).astype(np.int64)

    def extend(self, symbol, lo, hi):
        """Intervals of the suffixes that begin with ``symbol`` before those of [lo, hi)."""
        base = symbol * (self.size + 1)
        return np.searchsorted(self.keys, base + lo), np.searchsorted(self.keys, base + hi)

    def children(self, lo, hi) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, symbol, lo, hi) of every letter that stands before the suffixes of each interval."""
        letters, wide = len(self.alphabet), (hi - lo) > len(self.alphabet)
        n = np.where(wide, letters, hi - lo)
        row = np.repeat(np.arange(len(lo)), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        symbol = np.where(wide[row], step + 1, self.before[np.minimum(lo[row] + step, self.size - 1)])
        pair = np.unique(row * (letters + 2) + symbol)
        row, symbol = pair // (letters + 2), pair % (letters + 2)
        row, symbol = row[symbol > 0], symbol[symbol > 0]
        new_lo, new_hi = self.extend(symbol, lo[row], hi[row])
        some = new_hi > new_lo
        return row[some], symbol[some], new_lo[some], new_hi[some]

    def one_edit(self, flat: np.ndarray, n: np.ndarray, exact: np.ndarray, change: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) for the words that end on the query's last ``exact`` symbols and are one edit away.

        ``change`` is the word's length less the query's: 0 replaces, 1 inserts and -1 leaves out a symbol.
        Each pair is found once: an insertion or deletion in a run of equal symbols counts at its far end.
        """
        symbol = np.concatenate([self.symbols(flat), [0]])
        end = np.cumsum(n)
        begin = end - n

        def symbol_at(q, t):
            """The query's symbol t places before its end; the delimiter beyond its start."""
            return np.where(t < n[q], symbol[np.maximum(end[q] - 1 - t, begin[q])], 0)

        q = np.flatnonzero(exact <= n)
        lo = np.zeros(len(q), dtype=np.int64)
        lo, hi = self.extend(lo, lo, np.full(len(q), self.size))
        matched = 0
        late = [(np.zeros(0, np.int64),) * 4]  # states with the edit behind them: query, symbols read, interval
        found = []
        while len(q) or len(late[0][0]):
            if len(q):
                now = exact[q] <= matched
                late += self._branch(q[now], matched, lo[now], hi[now], change, n, symbol_at)
                go = n[q] > matched
                q, lo, hi = q[go], lo[go], hi[go]
                lo, hi = self.extend(symbol_at(q, np.full(len(q), matched)), lo, hi)
                some = hi > lo
                q, lo, hi = q[some], lo[some], hi[some]
                matched += 1
            lq, lt, llo, lhi = (np.concatenate(x) for x in zip(*late))
            nlo, nhi = self.extend(symbol_at(lq, lt), llo, lhi)
            some, done = nhi > nlo, lt >= n[lq]
            ended = some & done & (nlo > 0)  # row 0 is the closing delimiter, before which no word begins
            found.append((lq[ended], nlo[ended] - 1))
            stay = some & ~done
            late = [(lq[stay], lt[stay] + 1, nlo[stay], nhi[stay])]
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 2

    def _branch(self, q, matched, lo, hi, change, n, symbol_at) -> list:
        """The states that spend their edit after ``matched`` symbols."""
        t = np.full(len(q), matched)
        here = symbol_at(q, t)
        cut = (change[q] == -1) & (t < n[q]) & (here != symbol_at(q, t + 1))
        out = [(q[cut], t[cut] + 1, lo[cut], hi[cut])]
        grow = np.flatnonzero((change[q] == 1) | ((change[q] == 0) & (t < n[q])))
        if len(grow):
            # Queries that read the same symbols stand on the same interval: its children are looked up once.
            span, which = np.unique(lo[grow] * (self.size + 1) + hi[grow], return_inverse=True)
            row, symbol, clo, chi = self.children(span // (self.size + 1), span % (self.size + 1))
            first = np.searchsorted(row, np.arange(len(span) + 1))
            count = np.diff(first)[which]
            at = np.repeat(np.arange(len(grow)), count)
            child = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + first[which][at]
            other = symbol[child] != here[grow][at]
            at, child = grow[at[other]], child[other]
            out.append((q[at], t[at] + (change[q[at]] == 0), clo[child], chi[child]))
        return out


# ---------------------------------------------------------------- the search on Spark


def _filed(vocab: DataFrame, name: str) -> DataFrame:
    """Both halves of every word: (side, half, m, text), ``text`` read towards the half (reversed for first halves)."""
    m = F.char_length(name)
    h = F.floor(m / 2).cast("int")
    first = F.struct(F.lit(0).alias("side"), F.substring(F.col(name), F.lit(1), h).alias("half"), F.reverse(name).alias("text"))
    last = F.struct(F.lit(1).alias("side"), F.substring(F.col(name), h + 1, m - h).alias("half"), F.col(name).alias("text"))
    return vocab.withColumn("f", F.explode(F.array(first, last))).select("f.side", "f.half", m.alias("m"), "f.text", "n")


def _asked(vocab: DataFrame, name: str) -> DataFrame:
    """What every word asks: for each length at one edit, its first and its last code points of a half's length."""
    own = F.char_length(name)
    wide = vocab.withColumn("m", F.explode(F.array(own - 1, own, own + 1))).where("m > 0")
    h = F.floor(F.col("m") / 2).cast("int")
    tail = F.col("m") - h
    first = F.struct(F.lit(0).alias("side"), F.substring(F.col(name), F.lit(1), h).alias("half"), F.reverse(name).alias("text"), h.alias("exact"))
    last = F.struct(F.lit(1).alias("side"), F.substring(F.col(name), own - tail + 1, tail).alias("half"), F.col(name).alias("text"), tail.alias("exact"))
    return wide.withColumn("f", F.explode(F.array(first, last))).where(F.col("f.exact") <= own).select("f.side", "f.half", "m", "f.text", "f.exact")


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of (shard, side, kind): an index's words, then the queries to it."""
    where, words, weights, index = None, [], [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        shard, side, kind, m, exact, n = (batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1, 2, 4, 5, 6))
        text = batch.column(3).to_pylist()
        cut = np.flatnonzero((np.diff(shard) != 0) | (np.diff(side) != 0) | (np.diff(kind) != 0)) + 1
        for a, b in zip([0, *cut], [*cut, len(text)]):
            if (shard[a], side[a]) != where:
                where, words, weights, index = (shard[a], side[a]), [], [], None
            if kind[a] == 0:
                words += text[a:b]
                weights.append(n[a:b])
                continue
            if not words:
                continue
            if index is None:
                index, weight = FMIndex(words), np.concatenate(weights)
                all_points, lengths = code_points(words)
                starts = np.cumsum(lengths) - lengths
            flat, size = code_points(text[a:b])
            q, w = index.one_edit(flat, size, exact[a:b], m[a:b] - size)
            if side[a] == 1 and len(q):
                # A word whose first half fits too is found on the other side.
                h, first = lengths[w] // 2, np.cumsum(size) - size
                same = size[q] >= h
                for i in range(int(h.max())):
                    look = np.flatnonzero(same & (h > i))
                    same[look] = all_points[starts[w[look]] + i] == flat[first[q[look]] + i]
                q, w = q[~same], w[~same]
            if not len(q):
                continue
            # The best neighbour: largest n, then smallest word (words are sorted, but reversed on side 0).
            rank = w if side[a] == 1 else np.argsort(np.argsort(np.array([words[i][::-1] for i in w], dtype=object), kind="stable"), kind="stable")
            order = np.lexsort((rank, -weight[w], q))
            q, w = q[order], w[order]
            head = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
            back = slice(None, None, -1 if side[a] == 0 else 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([text[a + i][back] for i in q[head]], pa.string()),
                    pa.array(np.diff(np.concatenate([head, [len(q)]]))),
                    pa.array(weight[w[head]]),
                    pa.array([words[i][back] for i in w[head]], pa.string()),
                ],
                names=["word", "n_near", "best_n", "best"],
            )


def neighbours(vocab: DataFrame, shard: int = SHARD, file: int = FILE) -> DataFrame:
    """(word, n_near, best_n, best) for each word of (word, n), distinct words, that has a word at one edit."""
    spark = vocab.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * vocab.count() // shard))
    key = ["side", "half", "m"]
    filed, asked = _filed(vocab, "word"), _asked(vocab, "word")
    # Halves with very many words: as many as words / file, so few that Spark's measured join is a broadcast.
    large = materialize(filed.groupBy(*key).count().where(F.col("count") > file).select(*key, F.ceil(F.col("count") / file).cast("int").alias("parts")), "spelling-large")
    if not large.isEmpty():
        one = F.coalesce("parts", F.lit(1))
        filed = filed.join(large, key, "left").withColumn("part", F.pmod(F.xxhash64("text"), one)).drop("parts")
        asked = asked.join(large, key, "left").withColumn("part", F.explode(F.sequence(F.lit(0), one - 1))).drop("parts")
    else:
        filed, asked = filed.withColumn("part", F.lit(0)), asked.withColumn("part", F.lit(0))
    # Two parts of one file in one shard are one index: such queries are asked there once.
    place = F.pmod(F.xxhash64(*key, F.col("part").cast("int")), F.lit(parts)).cast("int").alias("shard")
    filed = filed.select(place, "side", F.lit(0).alias("kind"), "text", "m", F.lit(0).alias("exact"), "n")
    asked = asked.select(place, "side", F.lit(1).alias("kind"), "text", "m", "exact", F.lit(0).cast("long").alias("n"))
    if not large.isEmpty():
        asked = asked.distinct()
    rows = filed.unionByName(asked).repartition(parts, "shard").sortWithinPartitions("shard", "side", "kind", "text")
    found = rows.mapInArrow(_search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("key"), "best")).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("b.key")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for every word of (word, form): the end of its chain of forms, which must not be circular."""
    now = materialize(forms.select("word", F.col("form").alias("to"), F.lit(False).alias("done")), "spelling-roots")
    while not (active := now.where("NOT done")).isEmpty():
        # Only words whose pointer can still move are joined, so the many words of one root do not meet on its key.
        ahead = now.select(F.col("word").alias("_at"), F.col("to").alias("_to"), F.col("done").alias("_done"))
        moved = active.join(ahead, F.col("to") == F.col("_at"), "left")
        moved = moved.select("word", F.coalesce("_to", "to").alias("to"), F.coalesce("_done", F.lit(True)).alias("done"))
        now = materialize(now.where("done").unionByName(moved), "spelling-roots")
    return now.select("word", F.col("to").alias("root"))


def variant_groups(vocab: DataFrame, ratio: int = 2, shard: int = SHARD, file: int = FILE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for a vocabulary of distinct words (word, n)."""
    vocab = materialize(vocab.select("word", F.col("n").cast("long")), "spelling-words")
    near = neighbours(vocab, shard, file)
    better = F.col("best_n") >= ratio * F.col("n")
    judged = vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(better, F.col("best")).alias("form"), F.when(better, F.col("best_n")).alias("form_n")
    )
    judged = materialize(judged, "spelling-forms")
    ends = roots(judged.where("form IS NOT NULL").select("word", "form"))
    return judged.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: CRC-32 of a string, a half byte at a time. The table of the reflected polynomial 0xEDB88320 for four bits.
_CRC_TABLE = (0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
              0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C)

ORACLE_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
coded AS (
  SELECT run, c, hex(encode(id || ':' || run)) AS x FROM (SELECT id, run, count(*) AS c FROM runs WHERE length(run) >= 5 GROUP BY ALL)),
hashed AS (
  SELECT run, c, xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(CAST(length(x) AS BIGINT)),
      lambda i: CAST(strpos('0123456789ABCDEF', x[CASE WHEN i % 2 = 0 THEN i + 2 ELSE i END]) - 1 AS BIGINT))),
    lambda crc, d: xor(crc >> 4, {list(_CRC_TABLE)}[(xor(crc, d) & 15) + 1]))) AS h
  FROM coded),
noisy AS (
  SELECT CASE WHEN h % 97 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, c FROM hashed),
vocab AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
cuts AS (SELECT word, n, i, word[1 : i] || word[i + 2 :] AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM vocab)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN vocab b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN vocab b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n FROM near GROUP BY word),
forms AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 2 * v.n THEN b.best_n END AS form_n,
    CASE WHEN b.best_n >= 2 * v.n THEN (SELECT min(other) FROM near x WHERE x.word = v.word AND x.other_n = b.best_n) END AS form
  FROM vocab v LEFT JOIN best b ON v.word = b.word),
chain AS (
  SELECT word, word AS at, form AS next FROM forms
  UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON c.next = f.word)
SELECT f.word, f.form, c.at AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, f.form_n
FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
"""
