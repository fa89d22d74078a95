"""Byte-level BPE as a bounded-lookahead streaming transducer, with an incremental decoder.

The tokenizer file gives a vocabulary, a merge list, and special strings that are
cut out first. Text then splits into pre-tokens, and inside each pre-token merges
apply by rank. Two bounds make this a transducer with constant memory:

* Pre-tokens: a match is final once ``SETTLED`` characters follow it, since the
  split pattern looks no further (its longest contraction has three characters,
  its white-space rule looks one ahead).
* Merges: ``sufficient_lookahead`` computes from the merge list how many bytes
  after a token's end can still change it. A token with that many bytes behind it
  is emitted; what follows is encoded afresh from there, because no merge crosses
  a boundary of the final result.

A pre-token of any length (a megabyte of one letter) therefore passes through a
buffer of fixed size. Frequent pre-tokens are kept in a bounded table.

Decoding maps ids to bytes and bytes to text with an incremental UTF-8 state
machine; malformed sequences become U+FFFD, a maximal subpart each.

Nulls and odd rows (``encode_table``): a null text is an empty one and gives zero
tokens; repeated rows give repeated results; other columns of the input, whatever
their names, are ignored, and an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Split pattern of the byte-level pre-tokenizer (fixed value).
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters after a match that settle it.
SETTLED = 2
#: Characters fed at once; an unsettled rest longer than OPEN_AT is one run and goes to the open state.
PIECE, OPEN_AT = 1 << 16, 1 << 12
#: Bytes of an open run that are encoded together (beside the lookahead).
WINDOW = 1 << 12
#: Pre-tokens kept with their ids; the table is emptied when full.
TABLE = 1 << 18
_FAR = 1 << 60

_RUNS = [(regex.compile(r"\s*"), True), (regex.compile(r"\p{L}*"), False), (regex.compile(r"\p{N}*"), False), (regex.compile(r"[^\s\p{L}\p{N}]*"), False)]


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable in Latin-1, else the next one from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = {}, 0x100
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b], spare = chr(spare), spare + 1
    return [out[b] for b in range(256)]


class Transducer:
    """Encoder and decoder of one tokenizer file (its JSON text)."""

    def __init__(self, spec: str) -> None:
        j = json.loads(spec)
        vocab: dict[str, int] = j["model"]["vocab"]
        symbols = byte_symbols()
        self.byte_ids = [vocab[s] for s in symbols]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for merge in j["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pair = (vocab[a], vocab[b])
            self.rank.setdefault(pair, len(self.made))
            self.made.append(vocab[a + b])
        back = {s: b for b, s in enumerate(symbols)}
        self.bytes_of: dict[int, bytes] = {}
        for token, i in vocab.items():
            known = all(c in back for c in token)
            self.bytes_of[i] = bytes(back[c] for c in token) if known else token.encode()
        self.special: dict[str, int] = {}
        for t in j.get("added_tokens", []):
            self.special[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()
        self.name_of = {i: str(i) for i in self.bytes_of}
        self.lookahead = self.sufficient_lookahead()
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or r"(?!)")
        self.longest_special = max(map(len, self.special), default=1)
        self.table: dict[str, list[int]] = {}

    def sufficient_lookahead(self) -> int:
        """Bytes after a token's end that can still change it, from one pass over the merges in rank order.

        ``need[t]`` is that bound for token t after the merges so far. The merge
        u + v = t at rank r asks whether v stands after u before r, which v's length
        plus v's own need decide. So u's need grows to at least that, and t starts
        with v's need. Later merges cannot change an earlier decision.
        """
        need = dict.fromkeys(self.bytes_of, 0)
        size = {i: len(b) for i, b in self.bytes_of.items()}
        for (u, v), r in self.rank.items():
            t = self.made[r]
            after_v = need[v]
            need[u] = max(need[u], size[v] + after_v)
            need[t] = max(need[t], after_v)
        return max(need.values(), default=0)

    def merge(self, ids: list[int]) -> list[int]:
        """All merges in a sequence of byte ids, lowest rank first, then leftmost."""
        if len(ids) > 64:
            return self._merge_long(ids)
        get, made = self.rank.get, self.made
        ranks = [get(p, _FAR) for p in zip(ids, ids[1:])]
        while ranks:
            r = min(ranks)
            if r == _FAR:
                break
            i = ranks.index(r)
            ids[i : i + 2] = (made[r],)
            del ranks[i]
            if i:
                ranks[i - 1] = get((ids[i - 1], ids[i]), _FAR)
            if i < len(ranks):
                ranks[i] = get((ids[i], ids[i + 1]), _FAR)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """As ``merge``, with a heap over a linked list."""
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := self.rank.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or self.rank.get((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = self.made[r], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (s := self.rank.get((ids[i], ids[k]))) is not None:
                    heapq.heappush(heap, (s, i))
            if (h := before[i]) >= 0 and (s := self.rank.get((ids[h], ids[i]))) is not None:
                heapq.heappush(heap, (s, h))
        return [i for i in ids if i >= 0]

    def _pretoken(self, token: str) -> list[int]:
        if len(token) > OPEN_AT:
            out: list[int] = []
            rest = bytearray(token.encode())
            self._drain(rest, out, 0)
            return out + self.merge([self.byte_ids[b] for b in rest])
        ids = self.merge([self.byte_ids[b] for b in token.encode()])
        if len(token) <= 64:
            if len(self.table) >= TABLE:
                self.table.clear()
            self.table[token] = ids
        return ids

    def _drain(self, rest: bytearray, out: list[int], hold: int) -> None:
        """Emit the stable tokens of an open run; at most a window and the lookahead stay in ``rest``."""
        while len(rest) - hold > WINDOW + self.lookahead:
            end, used = WINDOW + self.lookahead, 0
            for i in self.merge([self.byte_ids[b] for b in rest[:end]]):
                size = len(self.bytes_of[i])
                if used + size + self.lookahead > end:
                    break
                out.append(i)
                used += size
            del rest[:used]

    def _sections(self, pieces: Iterable[str]) -> Iterator[tuple[str, int | None]]:
        """(text, None) for text between special strings, ('', id) at each of them; holds back a possible start of one."""
        rest = ""
        for piece in pieces:
            rest += piece
            at = 0
            for m in self.cut.finditer(rest):
                if m.start() > at:
                    yield rest[at : m.start()], None
                yield "", self.special[m[0]]
                at = m.end()
            keep = max(at, len(rest) - self.longest_special + 1)
            if keep > at:
                yield rest[at:keep], None
            rest = rest[keep:]
        if rest:
            yield rest, None

    def encode_stream(self, pieces: Iterable[str]) -> Iterator[list[int]]:
        """Ids of the text that the pieces make up, as they become stable."""
        rest, run, is_space, held = "", None, False, bytearray()
        for text, special in chain(self._sections(pieces), [("", -1)]):
            rest += text
            last = special is not None
            out: list[int] = []
            if run is not None:  # inside a run that was too long to hold
                end = run.match(rest).end()
                more = end < len(rest) or last
                take = end - 1 if is_space and not (end == len(rest) and last) and end else end
                if is_space and end == 0 and not last:
                    take = 0
                held += rest[:take].encode()
                rest = rest[take:]
                self._drain(held, out, 0)
                if more:
                    out += self.merge([self.byte_ids[b] for b in held])
                    run, held = None, bytearray()
            if run is None:
                at, get = 0, self.table.get
                for m in self.split.finditer(rest):
                    if not last and m.end() + SETTLED > len(rest):
                        break
                    token = m[0]
                    out += get(token) or self._pretoken(token)
                    at = m.end()
                rest = rest[at:]
                if len(rest) > OPEN_AT:
                    body = rest[1:] if rest[0] == " " and not rest[1].isspace() else rest
                    run, is_space = next((c, s) for c, s in _RUNS if c.match(body).end())
                    lead = len(rest) - len(body)
                    take = lead + run.match(body).end() - is_space
                    held += rest[:take].encode()
                    rest = rest[take:]
                    self._drain(held, out, 0)
            if special is not None and special >= 0:
                out.append(special)
            if out:
                yield out

    def encode(self, text: str) -> list[int]:
        if len(text) <= PIECE and not self.cut.search(text):  # one piece: every match is final
            get, make = self.table.get, self._pretoken
            return list(chain.from_iterable([get(t) or make(t) for t in self.split.findall(text)]))
        pieces = (text[i : i + PIECE] for i in range(0, len(text), PIECE))
        return list(chain.from_iterable(self.encode_stream(pieces)))

    def decode_stream(self, ids: Iterable[list[int]]) -> Iterator[str]:
        """Text of blocks of ids; bytes of an unfinished character wait for the next block."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        table = self.bytes_of.__getitem__
        for block in ids:
            yield machine.decode(b"".join(map(table, block)))
        yield machine.decode(b"", True)

    def decode(self, ids: list[int]) -> str:
        return "".join(self.decode_stream(ids[i : i + PIECE] for i in range(0, len(ids), PIECE)))


def read_spec(path: str) -> str:
    """A tokenizer file's text, read by the driver and sent to the tasks with the function that uses it."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_table(docs: DataFrame, spec: str, id_col: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every whole text, and the ids themselves if asked for."""
    shipped = docs.sparkSession.sparkContext.broadcast(spec)  # a tokenizer file: its size does not grow with the data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = Transducer(shipped.value)
        name = t.name_of.__getitem__
        for batch in batches:
            counts, hashes, decoded, kept = [], [], [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                n, first, all_ids = 0, True, []
                sha, back = hashlib.sha256(), hashlib.sha256()
                machine = codecs.getincrementaldecoder("utf-8")("replace")
                if len(text) <= PIECE:
                    blocks = [t.encode(text)] if text else []
                else:
                    blocks = t.encode_stream(text[i : i + PIECE] for i in range(0, len(text), PIECE))
                for ids in blocks:
                    n += len(ids)
                    sha.update((("" if first else ",") + ",".join(map(name, ids))).encode())
                    first = False
                    back.update(machine.decode(b"".join(map(t.bytes_of.__getitem__, ids))).encode())
                    if with_ids:
                        all_ids += ids
                back.update(machine.decode(b"", True).encode())
                counts.append(n), hashes.append(sha.hexdigest()), decoded.append(back.hexdigest()), kept.append(all_ids)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = f"doc_id {picked.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if with_ids:
        schema, names = schema + ", ids array<int>", [*names, "ids"]
    return picked.mapInArrow(run, schema)
