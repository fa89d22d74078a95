"""Line dedup: exact set-similarity join over lines, removing later matches.

A line is the set of its word ``ngram``-grams (a shorter line is one gram of all its
words). Tokens are ordered by rarity: the count of a gram's rarest word over all
texts, then its hash. Counts are kept in a table of fixed size, so words that share a
slot share a count; any order common to all lines gives the same join, the table only
decides how well it filters. With it:

* prefix filter: two lines with Jaccard similarity of ``threshold`` share a token among
  the first n - ceil(threshold * n) + 1 of each; a token with a word that occurs once in
  the corpus is in no other line and is left out, and so is one that no other line has as
  such (they are counted by themselves, and lines move with what is left);
* length, positional and bitmap filters: among lines that share a prefix token, those whose
  sizes, or whose positions of the token, leave too little for the overlap are parted, and
  so are those whose bitmaps (a bit for each token, by hash) differ in more bits than the
  sizes leave tokens to differ in: without these, lines that only share a common phrase
  would chain up to groups that grow faster than the corpus;
* the lines that remain connected are verified by exact Jaccard similarity, in pairs
  of blocks.

Equal sets are joined as one. A line is removed if an equal or similar line stands
before it in order of (document id, text hash, line number); the earlier line need
not be kept itself. Lines without a word are never compared and stay.

Nulls and odd rows: rows without an id come first in that order; a null text has no
lines; rows with the same id and text are one document (``decisions`` has one row for
them, ``deduplicate`` treats them alike); other columns are kept as they are; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curdle.llm import kernels as K
from curdle.llm.components import connected_components
from curdle.llm.setblocks import Group, in_block_pairs, labels, run_pairs, similar
from curdle.operators.materialize import discard, materialize, release_later, stage

NGRAM = 5
THRESHOLD = 0.8
#: Slots of the word-count table (a byte each; counts saturate at 255), and the pieces it is summed up in.
SLOTS, PIECES = 1 << 24, 64
#: Sets of a group that are filtered or verified at once.
FILTER_BLOCK, VERIFY_BLOCK = 1024, 512


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)


def _packed(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The pieces of a table that hold anything; one that is mostly empty as its places and their values."""
    for i, piece in enumerate(table.reshape(PIECES, -1)):
        at = np.flatnonzero(piece)
        if len(at):
            packed = at.astype(np.uint32).tobytes() + piece[at].tobytes() if 5 * len(at) < len(piece) else piece.tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed], pa.binary())], names=["piece", "n"])


def _add_packed(total: np.ndarray, packed: pa.BinaryScalar, add: Callable) -> None:
    """Adds a packed piece to the piece ``total`` by ``add``."""
    data = np.frombuffer(packed.as_buffer(), dtype=np.uint8)
    if len(data) == len(total):
        total[:] = add(total, data)
    else:
        n = len(data) // 5
        at = data[: 4 * n].view(np.uint32)
        total[at] = add(total[at], data[4 * n :])


def _saturated(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum(np.add(a, b, dtype=np.uint16), 255).astype(np.uint8)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    count = np.zeros(SLOTS, dtype=np.uint8)
    for batch in batches:
        for _, _, data, offsets in K.text_slices(batch.column(0)):
            slot, n = np.unique(_slot(K.words(data, offsets)[2]), return_counts=True)
            count[slot] = np.minimum(count[slot] + n, 255)
    yield from _packed(count)


def _table(parts: DataFrame, add: Callable) -> np.ndarray:
    """The table whose packed pieces are in ``parts``, summed up by ``add``; PIECES rows of a fixed size reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, n in zip(batch.column(0).to_pylist(), batch.column(1)):
                if piece not in total:
                    total[piece] = np.zeros(SLOTS // PIECES, dtype=np.uint8)
                _add_packed(total[piece], n, add)
        for piece, n in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([n.tobytes()], pa.binary())], names=["piece", "n"])

    out = np.zeros((PIECES, SLOTS // PIECES), dtype=np.uint8)
    for r in parts.repartition(PIECES, "piece").mapInArrow(run, "piece int, n binary").collect():
        out[r["piece"]] = np.frombuffer(r["n"], dtype=np.uint8)
    return out.reshape(-1)


def word_counts(texts: DataFrame) -> np.ndarray:
    """Saturated counts of all words of all texts."""
    return _table(texts.mapInArrow(_count_words, "piece int, n binary"), _saturated)


def lines_with_words(data: np.ndarray, offsets: np.ndarray):
    """Lines with a word: document and number of each, word hashes, and the first word of each (lines + 1)."""
    starts, _, h, _ = K.words(data, offsets)
    begin, end = K.runs(data != 0x0A, offsets)
    first = np.searchsorted(starts, np.append(begin, len(data)))
    some = np.diff(first) > 0
    begin, first = begin[some], np.append(first[:-1][some], len(starts))
    doc = np.searchsorted(offsets, begin, side="right") - 1
    return doc, _line_numbers(data, offsets, doc, begin), h, first


def _line_numbers(data: np.ndarray, offsets: np.ndarray, doc: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Line breaks before each place ``begin`` in its document."""
    breaks = np.flatnonzero(data == 0x0A)
    return np.searchsorted(breaks, begin) - np.searchsorted(breaks, offsets)[doc]


def slice_lines(data: np.ndarray, offsets: np.ndarray, counts: np.ndarray, ngram: int):
    """Lines with a word: document, number, token owners, tokens in order of rarity, and each token's count."""
    doc, number, h, first = lines_with_words(data, offsets)
    owner, token = K.shingles(h, first, ngram)
    # The count of a token's rarest word, in the same order as the tokens (shorter lines: of all their words).
    rare = counts[_slot(h)]
    n = np.bincount(owner, minlength=len(doc))
    at = np.arange(len(owner)) + (first[:-1] - np.cumsum(n) + n)[owner]
    padded, least_of = np.append(rare, np.full(ngram, 255, dtype=np.uint8)), rare.copy()
    for i in range(1, ngram):
        np.minimum(least_of, padded[i : i + len(rare)], out=least_of)
    least, width = least_of[at], np.diff(first)
    short = np.flatnonzero(width[owner] < ngram)
    if len(short):
        least[short] = rare[at[short]]
        for i in range(1, ngram):
            has = short[i < width[owner[short]]]
            least[has] = np.minimum(least[has], rare[at[has] + i])
    # By line, rarity, then token: one sort of all three in 64 bits, for which the token's last bits give way.
    bits = max(len(doc) - 1, 1).bit_length()
    key = (owner.astype(np.uint64) << np.uint64(64 - bits)) | (least.astype(np.uint64) << np.uint64(56 - bits)) | (token >> np.uint64(8 + bits))
    order = np.argsort(key)
    tied = key[order[1:]] == key[order[:-1]]
    if (tied & (token[order[1:]] != token[order[:-1]])).any():  # the bits that gave way tell two tokens of a line apart
        order = np.lexsort((token, least, owner))
    owner, token, least = owner[order], token[order], least[order]
    keep = np.ones(len(owner), dtype=bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (token[1:] != token[:-1])
    return doc, number, owner[keep], token[keep], least[keep]


def _needed(n: np.ndarray, threshold: float) -> np.ndarray:
    return np.ceil(threshold * n - 1e-9).astype(np.int64)


#: 64-bit words of a line's bitmap.
BITMAP = 4
_BITMAP = [f"b{i}" for i in range(BITMAP)]
_LINES = "doc_id long, th long, line int, sid long, h long, n int, tokens array<long>, places array<smallint>, " + ", ".join(f"{b} long" for b in _BITMAP)


def _bitmaps(owner: np.ndarray, token: np.ndarray, n: int) -> np.ndarray:
    """The bitmaps of ``n`` lines, a row each."""
    has = np.zeros((n, 64 * BITMAP), dtype=bool)
    has[owner, (token >> np.uint64(8)).astype(np.int64) % (64 * BITMAP)] = True
    return np.packbits(has, axis=1).view(np.int64)


def _lines(docs: DataFrame, shipped: Broadcast, ngram: int, threshold: float) -> DataFrame:
    """A row for each line with a word, and one with line -1 for each document; ``shipped`` holds the word counts."""
    names = [c.split()[0] for c in _LINES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            none = pa.nulls(batch.num_rows, pa.int64())
            empty = pa.nulls(batch.num_rows, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([-1] * batch.num_rows, pa.int32()), none, none, pa.nulls(batch.num_rows, pa.int32()), empty, pa.nulls(batch.num_rows, pa.list_(pa.int16())), *[none] * BITMAP],
                names=names,
            )
            for a, b, data, offsets in K.text_slices(batch.column(2)):
                doc, number, owner, token, least = slice_lines(data, offsets, shipped.value, ngram)
                if not len(doc):
                    continue
                first = np.searchsorted(owner, np.arange(len(doc) + 1))
                n = np.diff(first)
                place = np.arange(len(owner)) - first[owner]
                # A place beyond 32,767 counts as that, which only makes the positional filter's bound larger.
                prefix = (place < (n - _needed(n, threshold) + 1)[owner]) & (least > 1)
                cut = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[prefix], minlength=len(doc)))]).astype(np.int32))
                sums = [K.as_long(K.mix(np.add.reduceat(K.mix(token ^ K.seed(i)), first[:-1]))) for i in (1, 2)]
                rows, bits, without = pa.array(doc), _bitmaps(owner, token, len(doc)), np.diff(cut) == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(rows), batch.column(1).slice(a, b - a).take(rows), pa.array(number, pa.int32()), *sums, pa.array(n, pa.int32()),
                        pa.ListArray.from_arrays(cut, K.as_long(token[prefix])), pa.ListArray.from_arrays(cut, pa.array(np.minimum(place[prefix], 32767), pa.int16())),
                        *[pa.array(bits[:, i], mask=without) for i in range(BITMAP)],
                    ],
                    names=names,
                )

    return docs.mapInArrow(run, _LINES)


#: Bits of a token that are counted; two tokens that share them count as one, which only lets both through.
COUNTED_BITS = 40


def _token_bits(counted: np.ndarray) -> Iterator[np.ndarray]:
    """The three bits that the counted bits of each token set in the table of repeated tokens."""
    yield counted & (8 * SLOTS - 1)
    other = K.mix(counted.view(np.uint64))
    for shift in (0, 32):
        yield (other >> np.uint64(shift)).astype(np.int64) & (8 * SLOTS - 1)


def _repeated_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(SLOTS, dtype=np.uint8)
    for batch in batches:
        for at in _token_bits(batch.column(0).to_numpy()):
            np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    yield from _packed(bits)


def _repeated(lines: DataFrame) -> np.ndarray:
    """A bit table of fixed size with a bit for each prefix token that more than one line has; only narrow counts move."""
    counted = lines.select(F.explode("tokens").alias("token")).select(F.shiftrightunsigned("token", 64 - COUNTED_BITS).alias("token"))
    again = counted.groupBy("token").agg(F.count("*").alias("n")).where("n > 1").select("token")
    return _table(again.mapInArrow(_repeated_pieces, "piece int, n binary"), np.bitwise_or)


def _with_repeated(lines: DataFrame, shipped: Broadcast) -> DataFrame:
    """``lines`` with only those of their prefix tokens that the bit table ``shipped`` has, and their places."""
    names = lines.columns
    tokens_at, places_at = names.index("tokens"), names.index("places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            n = pc.list_value_length(columns[tokens_at]).fill_null(0).to_numpy(zero_copy_only=False)
            token, place = columns[tokens_at].flatten(), columns[places_at].flatten()
            counted = (token.to_numpy().view(np.uint64) >> np.uint64(64 - COUNTED_BITS)).astype(np.int64)
            kept = np.ones(len(counted), dtype=bool)
            for bit in _token_bits(counted):
                kept &= ((shipped.value[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(bool)
            owner = np.repeat(np.arange(batch.num_rows), n)
            cut = pa.array(np.concatenate([[0], np.cumsum(np.bincount(owner[kept], minlength=batch.num_rows))]).astype(np.int32))
            kept = pa.array(kept)
            columns[tokens_at] = pa.ListArray.from_arrays(cut, token.filter(kept))
            columns[places_at] = pa.ListArray.from_arrays(cut, place.filter(kept))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    # Lines without such a token are compared with none: what serves that goes too.
    needed = {c: F.when(F.size("tokens") > 0, F.col(c)).alias(c) for c in ("n", *_BITMAP)}
    return lines.mapInArrow(run, lines.schema).select(*[needed.get(c, F.col(c)) for c in names])


def _may_match(threshold: float, n, m, i, j):
    """The length and positional filters, for lines of ``n`` and ``m`` tokens that share their ``i``-th and ``j``-th."""
    # Overlap that the sizes ask for, and the most that tokens before, at and after the shared one can give.
    need = np.ceil(threshold / (1 + threshold) * (n + m) - 1e-9)
    most = np.minimum(i, j) + np.minimum(n - i, m - j)
    return (np.minimum(n, m) >= threshold * np.maximum(n, m) - 1e-9) & (most >= need)


def _bits_may_match(threshold: float, n, m, a: np.ndarray, b: np.ndarray):
    """The bitmap filter: a bit that one of two lines has alone stands for a token at least that the other lacks."""
    need = np.ceil(threshold / (1 + threshold) * (n + m) - 1e-9)
    return n + m - np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64) >= 2 * need


def _bits_of(rows: Group) -> np.ndarray:
    return np.stack([rows[b] for b in _BITMAP], axis=-1).view(np.uint64)


def _filter_twos(threshold: float):
    """The tokens of two lines that the filters leave connected."""

    def work(rows: Group, i: np.ndarray, j: np.ndarray) -> tuple:
        n, place, bits, a, b = rows["n"].astype(np.int64), rows["place"].astype(np.int64), _bits_of(rows), rows["sid"][i], rows["sid"][j]
        good = (a != b) & _may_match(threshold, n[i], n[j], place[i], place[j]) & _bits_may_match(threshold, n[i], n[j], bits[i], bits[j])
        return np.maximum(a, b)[good], np.minimum(a, b)[good]

    return work


def _filter_forest(threshold: float):
    """A spanning forest of the lines of one token that the filters leave connected."""

    def work(group: Group) -> tuple | None:
        sid, at = np.unique(group["sid"], return_index=True)
        if len(sid) < 2:
            return None
        n, place, side = (group[c][at].astype(np.int64) for c in ("n", "place", "side"))
        bits = _bits_of(group)[at]
        cross = side.any() and not side.all()
        label = np.arange(len(sid))

        def near(r) -> np.ndarray:
            found = _may_match(threshold, n[r], n, place[r], place) & _bits_may_match(threshold, n[r], n, bits[r], bits)
            return found & (side != side[r]) if cross else found

        if len(sid) <= 64:
            label = labels(near(np.arange(len(sid))[:, None]))
        else:
            for r in range(len(sid)):
                if not r % 64 and (label == label[0]).all():
                    break  # all are connected
                met = np.unique(np.append(label[near(r)], label[r]))
                if len(met) > 1:
                    label[np.isin(label, met)] = met[0]
        moved = np.flatnonzero(label != np.arange(len(sid)))
        return (sid[moved], sid[label[moved]]) if len(moved) else None

    return work


def _verify(threshold: float):
    """The lines of two blocks that are similar to an earlier one."""

    def work(group: Group) -> tuple | None:
        sid, at = np.unique(group["sid"], return_index=True)
        linked = similar(group, at, "grams", threshold)
        rank = np.empty(len(sid), dtype=np.int64)
        rank[np.lexsort([group[c][at] for c in ("line", "th", "doc_id", "has_id")])] = np.arange(len(sid))
        later = (linked & (rank[None, :] < rank[:, None])).any(axis=1)
        return (sid[later],) if later.any() else None

    return work


def _mark(doc_id: np.ndarray, th: np.ndarray, line: np.ndarray) -> np.ndarray:
    """The bit that a line sets in the table of wanted lines."""
    u = lambda x: np.ascontiguousarray(x, dtype=np.int64).view(np.uint64)
    return (K.mix(u(th) + K.mix(u(doc_id) + K.mix(u(line) + K.seed(77)))) >> np.uint64(8)).astype(np.int64) & (8 * SLOTS - 1)


def _mark_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(SLOTS, dtype=np.uint8)
    for batch in batches:
        m = _mark(*(batch.column(i).fill_null(0).to_numpy(zero_copy_only=False) for i in range(3)))
        np.bitwise_or.at(bits, m >> 3, (1 << (m & 7)).astype(np.uint8))
    yield from _packed(bits)


def _wanted(lines: DataFrame) -> np.ndarray:
    """A bit table of fixed size with a bit for each wanted line (doc_id, th, line)."""
    return _table(lines.mapInArrow(_mark_pieces, "piece int, n binary"), np.bitwise_or)


def _grams(texts: DataFrame, shipped: Broadcast, ngram: int) -> DataFrame:
    """(doc_id, th, line, sid, grams) of all lines marked in the table ``shipped``, and of a few others that share a bit with one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, ths = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy()
            for a, b, data, offsets in K.text_slices(batch.column(2)):
                begin, end = K.runs(data != 0x0A, offsets)
                doc = np.searchsorted(offsets, begin, side="right") - 1
                number = _line_numbers(data, offsets, doc, begin)
                m = _mark(doc_ids[a + doc], ths[a + doc], number)
                picked = np.flatnonzero((shipped.value[m >> 3] >> (m & 7).astype(np.uint8)) & 1)
                # Words are looked for in the lines that are wanted only.
                n = (end - begin)[picked]
                borders = np.concatenate([[0], np.cumsum(n)])
                its_bytes = np.arange(borders[-1]) + np.repeat(begin[picked] - borders[:-1], n)
                _, _, h, first = K.words(data[its_bytes], borders)
                some = np.diff(first) > 0
                picked, borders = picked[some], np.append(first[:-1][some], len(h))
                if not len(picked):
                    continue
                owner, token = K.distinct(*K.shingles(h, borders, ngram))
                first = np.searchsorted(owner, np.arange(len(picked) + 1))
                grams = [token[first[i] : first[i + 1]] for i in range(len(picked))]
                sid = K.mix(np.array([K.mix(g ^ K.seed(1)).sum(dtype=np.uint64) for g in grams], dtype=np.uint64))
                rows = pa.array(doc[picked])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).take(rows), batch.column(1).slice(a, b - a).take(rows), pa.array(number[picked], pa.int32()),
                        K.as_long(sid), pa.array([g.tobytes() for g in grams], pa.binary()),
                    ],
                    names=["doc_id", "th", "line", "sid", "grams"],
                )

    return texts.mapInArrow(run, "doc_id long, th long, line int, sid long, grams binary")


def _with_key(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    t = F.col(text).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(t).alias("th"), F.coalesce(t, F.lit("")).alias("text"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ngram: int = NGRAM, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, th, n_lines, removed): how many lines with a word each document has, and the numbers (from 0) of those removed."""
    found, paths = _decided(docs, id_col, text, ngram, threshold)
    for path in paths:
        release_later(docs.sparkSession, path)
    return found


def _decided(docs: DataFrame, id_col: str, text: str, ngram: int = NGRAM, threshold: float = THRESHOLD) -> tuple[DataFrame, list[str]]:
    """``decisions``, and the staged folders that it reads."""
    spark = docs.sparkSession
    own = _with_key(docs, id_col, text)
    counts = spark.sparkContext.broadcast(word_counts(own.select("text")))  # SLOTS bytes, whatever the data
    full, full_path = stage(_lines(own, counts, ngram, threshold), "lines")
    counts.destroy()
    place = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "th", "line")
    # Most prefix tokens are in no other line: they are counted first, and lines go on without them.
    repeated = spark.sparkContext.broadcast(_repeated(full))  # SLOTS bytes, whatever the data
    lean, lean_path = stage(_with_repeated(full, repeated), "lines-repeated")
    repeated.destroy()
    discard(spark, full_path)
    of_set = ("n", "tokens", "places", *_BITMAP)
    sets, sets_path = stage(
        lean.where("line >= 0").groupBy("sid", "h").agg(F.min(place).alias("at"), F.count("*").alias("lines"), *[F.first(c).alias(c) for c in of_set]), "line-sets"
    )
    # Only places and identities are read from here on; the tokens of all lines go.
    lines, lines_path = stage(lean.select("doc_id", "th", "line", "sid"), "line-places")
    discard(spark, lean_path)
    entries = sets.select("sid", "n", *_BITMAP, F.explode(F.arrays_zip("tokens", "places")).alias("e")).select(
        "sid", "n", *_BITMAP, F.col("e.tokens").alias("token"), F.col("e.places").alias("place")
    )
    # Written, so that both sides of the join are shuffles of their own and a frequent token's rows can be split.
    sizes, sizes_path = stage(sets.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("size")).where("size > 1"), "line-tokens")
    met = in_block_pairs(entries.join(sizes, "token"), "token", "size", FILTER_BLOCK).select("pair", "side", "sid", "n", "place", *_BITMAP)
    forest = run_pairs(met, _filter_forest(threshold), "a long, b long", _filter_twos(threshold))
    found, found_path = stage(connected_components(forest, "line-candidates"), "line-candidates")
    known, known_path = stage(sets.select("sid", "at", "lines"), "line-set-places")
    for path in (sizes_path, sets_path):
        discard(spark, path)
    of_comp = found.groupBy("root").agg(F.count("*").alias("size"))
    candidates = found.join(of_comp, "root").join(known.select(F.col("sid").alias("node"), "at.*"), "node")
    candidates = candidates.select(F.col("node").alias("sid"), F.col("root").alias("comp"), "size", F.col("has_id").cast("int").alias("has_id"), "doc_id", "th", "line")
    candidates, candidates_path = stage(candidates, "line-candidate-places")
    # The candidates' tokens come from a second scan, by a bit table; what it lets through wrongly the join drops.
    wanted = spark.sparkContext.broadcast(_wanted(candidates.select("doc_id", "th", "line")))  # SLOTS bytes, whatever the data
    grams = _grams(own, wanted, ngram)
    grams = grams.select("sid", "grams", *[F.col(c).alias(f"_{c}") for c in ("doc_id", "th", "line")])
    same_place = (F.col("_th") == F.col("th")) & (F.col("_line") == F.col("line")) & F.col("_doc_id").eqNullSafe(F.col("doc_id"))
    grams = grams.join(candidates, "sid").where(same_place)
    blocks = in_block_pairs(grams, "comp", "size", VERIFY_BLOCK).select("pair", "side", "sid", "has_id", "doc_id", "th", "line", "grams")
    later = run_pairs(blocks, _verify(threshold), "sid long").distinct().select("sid", F.lit(True).alias("later"))
    # A set of one line that is not removed decides nothing: its line stays without being met.
    decided = known.join(later, "sid", "left").where("lines > 1 OR later").select("sid", "at", "later")
    decided, decided_path = stage(decided, "line-decisions")
    wanted.destroy()
    for path in (found_path, known_path, candidates_path):
        discard(spark, path)
    judged = lines.select("doc_id", "th", "line", "sid").join(decided, "sid", "left")
    gone = F.col("later").isNotNull() | (F.col("at").isNotNull() & ~place.eqNullSafe(F.col("at")))
    judged = judged.select("doc_id", "th", "line", F.when((F.col("line") >= 0) & gone, F.col("line")).alias("gone"))
    judged = judged.groupBy("doc_id", "th").agg(
        F.count_if(F.col("line") >= 0).alias("n_lines"), F.sort_array(F.collect_set("gone")).alias("removed")
    )
    return judged, [lines_path, decided_path]


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the removed lines; a document that loses its last line with a word goes with it."""
    spark = docs.sparkSession
    found, paths = _decided(docs, id_col, text, **options)
    # Written, so that the shuffles of lines are gone when documents move.
    found = materialize(found.where(F.size("removed") > 0).select(F.col("doc_id").alias("found_id"), F.col("th").alias("found_th"), "n_lines", "removed"), "line-removed")
    for path in paths:
        discard(spark, path)
    # The input's columns travel as one, so that none can clash with those added here.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    id_of, own = F.col("row").getField(id_col).cast("long"), F.col("row").getField(text).cast("string")
    joined = keyed.join(found, id_of.eqNullSafe(F.col("found_id")) & (F.xxhash64(own) == F.col("found_th")), "left")
    left = joined.where(F.col("removed").isNull() | (F.size("removed") < F.col("n_lines")))
    lines = F.split(own, "\n", -1)
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "removed"), lambda i: F.get(lines, i))
    new = F.when(F.col("removed").isNull(), own).otherwise(F.array_join(kept, "\n"))
    return left.select(*[new.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns])
