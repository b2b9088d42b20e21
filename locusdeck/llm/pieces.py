"""SentencePiece BPE encoding in vectorised merge rounds over flat numpy arrays.

The symbols of many words lie in one array. A round looks up the rank of every adjacent pair, takes
the least rank of each word, merges all its leftmost occurrences at once and closes the gaps; a
word leaves when none of its pairs can be merged. Merging at once equals the library's one by one
order if no piece made with the new symbol ranks before it; a piece for which that does not hold
is merged one occurrence a round, and runs of spaces, whose pieces all rank alike, are merged from the left.

Words are cut in front of a space mark and around a line end; no piece crosses such a cut. Words met before come from a
memo of bounded size. Decoding is the library's own ``decode``.

Defined results: NULL counts as empty, which has the begin and end ids only; texts are encoded
whole; repeated rows give repeated rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusdeck.llm.shared import BLOCK

MARK = "▁"
MEMO_WORDS = 500_000
_WORD = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
_NONE = np.int32(np.iinfo(np.int32).max)


class PairTable:
    """(left, right) -> number of the merge, in an open-addressing table that is looked up array-wise."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, int(2 * len(pairs) + 1).bit_length() + 1)
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, -1, np.int32)
        for (a, b), value in pairs.items():
            key = a << 32 | b
            at = int(self._slot(np.array([key], np.int64))[0])
            while self.keys[at] >= 0:
                at = (at + 1) & (size - 1)
            self.keys[at], self.values[at] = key, value

    def _slot(self, key: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            mixed = key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = self._slot(key)
        out = np.full(len(key), -1, np.int32)
        open_ = np.arange(len(key))
        while len(open_):
            there = self.keys[at]
            hit = there == key
            out[open_[hit]] = self.values[at[hit]]
            on = ~hit & (there >= 0)
            open_, key, at = open_[on], key[on], (at[on] + 1) & ((1 << self.bits) - 1)
        return out


class Encoder:
    """Encodes words of a BPE model with byte fallback, as the library does."""

    def __init__(self, model_file: str):
        from sentencepiece import SentencePieceProcessor

        self.model = sp = SentencePieceProcessor(model_file=model_file)
        n = sp.get_piece_size()
        bytes_ = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        probe = "  a  éﬁ ①\tb\n"
        if not all(sp.is_byte(b) for b in bytes_) or sp.decode(sp.encode(probe)) != probe:
            raise ValueError("only models that keep texts as they are and fall back to bytes")
        self.bytes_ = np.array(bytes_, np.int32)
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        usual = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        ids = {sp.id_to_piece(i): i for i in usual}
        if any(sp.is_unused(i) for i in usual) or any(MARK in p.lstrip(MARK) or "\n" in p for p in ids):
            raise ValueError("pieces that are unused, or hold a space inside or a line end, are not supported")
        score = {p: sp.get_score(i) for p, i in ids.items()}
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        # Characters that occur in pieces only get numbers behind the pieces; they end as bytes.
        symbols = dict(ids)
        for p in ids:
            for c in p:
                symbols.setdefault(c, n + len(symbols))
        self.known = n
        pairs, self.piece_of, rank, least = {}, [], [], {}
        for p, i in ids.items():
            for cut in range(1, len(p)):
                a, b = p[:cut], p[cut:]
                if a in symbols and b in symbols:
                    pairs[symbols[a], symbols[b]] = len(rank)
                    self.piece_of.append(i)
                    rank.append(order[score[p]])
                    for part in (a, b):
                        least[part] = min(least.get(part, _NONE), order[score[p]])
        self.pairs = PairTable(pairs)
        self.rank = np.array([*rank, _NONE], np.int32)
        # Whether all occurrences of a merge may be made at once.
        at_once = {i: least.get(p, _NONE) > order[score[p]] for p, i in ids.items()}
        self.at_once = np.array([at_once[i] for i in self.piece_of] + [True])
        self.piece_of = np.array([*self.piece_of, -1], np.int32)
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for p, s in symbols.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = s
        runs = {p: i for p, i in ids.items() if set(p) == {MARK}}
        self.runs = {len(p): i for p, i in runs.items()}
        self.run_length = {i: k for k, i in self.runs.items()}
        self.run_ids = list(self.run_length)
        self.longest = max(map(len, ids), default=1)
        tied = {order[score[p]] for p in runs if len(p) > 1}
        self.tied = tied.pop() if len(tied) == 1 else -1
        self.memo: dict[str, bytes] = {}

    def _spaces(self, symbols: list[int]) -> list[int]:
        """Merge runs of space pieces from the left until nothing more fits."""
        done: list[int] = []
        for k in (self.run_length[s] for s in symbols):
            done.append(k)
            while len(done) > 1 and done[-2] + done[-1] in self.runs:
                k = done.pop()
                done[-1] += k
        return [self.runs[k] for k in done]

    def _as_bytes(self, sym: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols with those that are no pieces replaced by the pieces of their bytes; how many each became."""
        odd = np.flatnonzero((sym < 0) | (sym >= self.known))
        width = np.ones(len(sym), np.int64)
        if not len(odd):
            return sym, width
        distinct, which = np.unique(code[odd], return_inverse=True)
        coded = [chr(c).encode("utf-8", "surrogatepass") for c in distinct.tolist()]
        long = np.array([len(c) for c in coded])[which]
        width[odd] = long
        out = np.repeat(sym, width)
        start = (np.cumsum(width) - width)[odd]
        for k in range(4):
            byte = np.array([c[k] if k < len(c) else 0 for c in coded])[which]
            out[start[long > k] + k] = self.bytes_[byte[long > k]]
        return out, width

    def _alone(self, where: np.ndarray, own: np.ndarray, pos: np.ndarray) -> np.ndarray:
        """Of the places of one merge: those further than two pieces from the one before, in their word.

        What a merge may set off stays within a piece's length, so such places cannot meet.
        """
        far = np.diff(pos[where]) > 2 * self.longest + 2
        return np.r_[True, far | (own[where][1:] != own[where][:-1])]

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and how many each word has."""
        counts = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
        sym = self.symbol_of[chars]
        pos = np.arange(len(sym))
        ids = np.flatnonzero(counts)  # the word of each row of ``counts``
        counts = counts[ids]
        merge = np.full(len(sym), -1, np.int32)
        ended: list[tuple[np.ndarray, ...]] = []  # word, symbol and character of what is finished

        def refresh(at: np.ndarray, own: np.ndarray) -> None:
            """Look the pairs that begin at ``at`` up."""
            merge[at] = -1
            at = at[at + 1 < len(sym)]
            at = at[(own[at] == own[at + 1]) & (sym[at] >= 0) & (sym[at + 1] >= 0)]
            merge[at] = self.pairs.find(sym[at], sym[at + 1])

        own = np.repeat(np.arange(len(ids)), counts)
        refresh(np.arange(len(sym)), own)
        while len(sym):
            rank = self.rank[merge]
            starts = np.cumsum(counts) - counts
            least = np.minimum.reduceat(rank, starts)
            done = least == _NONE
            tied = least == self.tied
            if tied.any() or counts[done].sum() * 4 >= len(sym):
                gone = np.repeat(done, counts)
                ended.append((ids[own[gone]], sym[gone], chars[pos[gone]]))
                for r in np.flatnonzero(tied).tolist():
                    # Only the leading run of spaces has pairs left, all of one rank.
                    a, b = starts[r], starts[r] + counts[r]
                    lead = a + int(np.argmin(np.r_[np.isin(sym[a:b], self.run_ids), False]))
                    run = np.array(self._spaces(sym[a:lead].tolist()), np.int32)
                    ended.append((np.full(len(run), ids[r]), run, np.full(len(run), ord(MARK), np.int32)))
                    ended.append((np.full(b - lead, ids[r]), sym[lead:b], chars[pos[lead:b]]))
                ready = done | tied
                stay = ~np.repeat(ready, counts)
                sym, pos, merge, rank = sym[stay], pos[stay], merge[stay], rank[stay]
                ids, counts, least = ids[~ready], counts[~ready], least[~ready]
                own = np.repeat(np.arange(len(ids)), counts)
                if not len(sym):
                    break
            where = np.flatnonzero((rank == least[own]) & (rank != _NONE))
            # Of places that follow one another every second is taken.
            fresh = np.r_[True, np.diff(where) != 1]
            begin = where[np.maximum.accumulate(np.where(fresh, np.arange(len(where)), 0))]
            take = ((where - begin) & 1) == 0
            take &= self.at_once[merge[where]] | self._alone(where, own, pos)
            chosen = where[take]
            sym[chosen] = self.piece_of[merge[chosen]]
            counts = counts - np.bincount(own[chosen], minlength=len(counts))
            stay = np.ones(len(sym), bool)
            stay[chosen + 1] = False
            sym, pos, merge, own = sym[stay], pos[stay], merge[stay], own[stay]
            now = chosen - np.arange(len(chosen))
            refresh(np.r_[now, now[now > 0] - 1], own)
        if not ended:
            return np.zeros(0, "<u4"), np.zeros(len(words), np.int64)
        word, symbol, code = (np.concatenate(x) for x in zip(*ended))
        order = np.argsort(word, kind="stable")
        flat, width = self._as_bytes(symbol[order], code[order])
        return flat.astype("<u4"), np.bincount(word[order], weights=width, minlength=len(words)).astype(np.int64)

    def remember(self, words: list[str]) -> None:
        """Put new words into the memo, as little-endian 32-bit ids."""
        flat, counts = self.encode_words(words)
        data = flat.tobytes()
        ends = (4 * np.cumsum(counts)).tolist()
        self.memo.update(zip(words, map(data.__getitem__, map(slice, [0, *ends], ends))))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with the begin and the end id."""
        begin, end = (np.array([i], "<u4").tobytes() for i in (self.begin, self.end))
        out: list[bytes] = []
        batch: list[list[str]] = []
        size = 0

        def flush() -> None:
            nonlocal size
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            self.remember(list(set().union(*batch).difference(self.memo)))
            get = self.memo.__getitem__
            out.extend(begin + b"".join(map(get, words)) + end for words in batch)
            batch.clear()
            size = 0

        for text in texts:
            marked = MARK + text.replace(" ", MARK) if text else ""
            batch.append(_WORD.findall(marked))
            size += len(text)
            if size >= BLOCK:
                flush()
        flush()
        return out

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


_encoders: dict[str, Encoder] = {}


def encoder(model_file: str) -> Encoder:
    """The process's encoder for a model file, which every worker can open."""
    if model_file not in _encoders:
        _encoders[model_file] = Encoder(model_file)
    return _encoders[model_file]


def encoded(docs: DataFrame, model_file: str, id_col: str = "doc_id", texts: bool = False) -> DataFrame:
    """n_tokens, digests of ids and decoded text for every row; with ``texts`` also ids and decoded text."""
    schema = docs.select(id_col).schema
    for name, kind in (("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")):
        schema = schema.add(name, kind)
    if texts:
        schema = schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model_file)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                ids = tool.encode([t or "" for t in batch.column(1).to_pylist()])
                back = [tool.decode(i) for i in ids]
                columns = [
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([sha(i) for i in ids]),
                    pa.array([sha(t.encode()) for t in back]),
                ]
                if texts:
                    columns.append(pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32())))
                    columns.append(pa.array(back))
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return docs.select(F.col(id_col), F.col("text").alias("_text")).mapInArrow(run, schema)
