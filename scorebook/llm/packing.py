"""Hierarchical multi-length packing of tokenised documents into training sequences.

Each document's ids (a public tokenizer, then ``end_id``) are cut into full windows of the longest tier; what remains
is routed to the shortest context tier that holds it. Tiers are packed from the longest down: a remainder longer than
half its window opens a window of its own, and the gap behind it is filled from shorter tiers, largest fitting piece
first, the last piece cut to end the window exactly. Remainders of the shortest tier fill windows of that tier. What
is left open every ``buffer_docs`` documents, and at a partition's end, is cut at powers of two, so that no sequence needs padding. Sequences are
dealt to step groups of exactly ``step_tokens`` tokens over all partitions: those of one size are numbered through, from
the partitions' counts as offsets, and fill groups of that size; what is left of each size, less than a group, fills mixed
groups from the longest size down. As sizes are powers of two, none straddles a group, and only the last mixed group of
the whole table may be short.

Texts are read in a single pass without a shuffle: every partition tokenises and packs its own documents as they stream
by, holding ``buffer_docs`` remainders at a time (counted where a run of texts ends: before it would pass ``RUN_BYTES`` or
``RUN_ROWS``, however the rows reach the worker), and writes its pieces to the scratch folder; step groups follow from
these narrow rows. The order inside a partition is the scan's, so a task that runs again makes the same sequences.

Tokenising: where a tokenizer's file names the normaliser and the pieces that are known here (``KNOWN_RULES``), texts
whose bytes are ASCII or Latin-1 letters are cut into those pieces in numpy, and each distinct piece is sent to the
tokenizer's model once per worker (bounded cache). Other texts, and all texts of any other tokenizer, go through the
tokenizer whole. Both give the tokenizer's ids.

Defined results: null and empty texts are the end id alone. Repeated rows are packed as often as they occur. Extra
columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import IS_SPACE, Roller, Texts, leased, materialise, process_cache, release_memory, text_slices

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int"
SCHEMA = f"{PIECES}, step_group long"
CACHE_PIECES = 250_000
RUN_BYTES, RUN_ROWS = 1 << 20, 10_000
ENCODE_BYTES = 1 << 18  # of the texts tokenised at once; temporaries are many times that

# The normaliser and the pieces of the tokenizers whose texts may be cut in numpy.
KNOWN_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Of a byte: 0 white space, 1 letter, 2 digit, 3 any other sign.
_KIND = np.full(256, 3, dtype=np.int8)
_KIND[IS_SPACE] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1


@dataclass(frozen=True)
class PackingConfig:
    tokenizer: str  #: path of a tokenizers JSON file
    end_id: int = 1
    tiers: tuple[int, ...] = (2048, 1024, 512, 256)
    step_tokens: int = 65_536
    buffer_docs: int = 4096


# ---------------------------------------------------------------- tokenising


def _byte_signs() -> dict[int, str]:
    """Byte-level BPE's printable sign for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def follows_known_rules(tokenizer: dict) -> bool:
    """Whether a tokenizer's definition has the known rules, adds nothing after them and cuts special tokens only at
    strings with "<|", which are looked for."""
    same = all(tokenizer.get(k) == v for k, v in KNOWN_RULES.items())
    plain = not tokenizer.get("post_processor") and not tokenizer.get("truncation") and not tokenizer.get("padding")
    return same and plain and all("<|" in t["content"] for t in tokenizer.get("added_tokens") or ())


class TextTokenizer:
    """Ids of whole texts; distinct pieces are encoded once."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known_rules = follows_known_rules(json.loads(self.tokenizer.to_str()))
        self.roller = Roller(41)
        self.signs = _byte_signs()
        self.clear()

    def clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.at = np.zeros(1 << 16, np.int64)
        self.count = np.zeros(1 << 16, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.used = 0

    def _learn(self, piece: bytes) -> int:
        """Number of the piece; its ids are in self.ids[at:at + count]."""
        if b"'" in piece:  # contractions are cut by the tokenizer itself
            ids = self.tokenizer.encode(piece.decode("utf-8"), add_special_tokens=False).ids
        else:
            ids = [t.id for t in self.tokenizer.model.tokenize(piece.decode("latin-1").translate(self.signs))]
        k = len(self.known)
        self.known[piece] = k
        if k >= len(self.at):
            self.at, self.count = np.resize(self.at, 2 * k), np.resize(self.count, 2 * k)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.at[k], self.count[k] = self.used, len(ids)
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return k

    def encode(self, texts: Texts) -> list[np.ndarray]:
        """uint32 ids of each text of a slice."""
        data, off = texts.data, texts.offsets
        n = len(data)
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        if not n:
            return out
        if not self.known_rules:
            return [self._whole(texts, i) for i in range(len(texts))]
        follows = np.zeros(n, dtype=bool)  # second byte of a letter C3 80 .. C3 BF
        follows[1:] = data[:-1] == 0xC3
        follows &= (data >= 0x80) & (data <= 0xBF) & (data != 0x97) & (data != 0xB7)
        lead = np.zeros(n, dtype=bool)
        lead[:-1] = follows[1:]
        odd = np.cumsum((data >= 128) & ~follows & ~lead)
        # A special token's string holds "<|"; such texts, too, are left to the tokenizer.
        special = np.zeros(n, dtype=np.int64)
        special[1:] = (data[1:] == 124) & (data[:-1] == 60)
        odd = np.concatenate([[0], odd + np.cumsum(special)])
        simple = odd[off[1:]] == odd[off[:-1]]
        low = _LOWER[data]
        kind = _KIND[data]
        if follows.any():
            low[follows & (data <= 0x9E)] += 32
            kind[follows | lead] = 1
        # A run with an apostrophe is joined with its neighbours up to white space and left to the tokenizer.
        if (data == 39).any():
            solid = kind > 0
            edge = np.zeros(n, dtype=bool)
            edge[1:] = solid[1:] != solid[:-1]
            edge[off[:-1][off[:-1] < n]] = True
            run = np.cumsum(edge)
            kind[np.isin(run, run[data == 39]) & solid] = 4
        begin = np.ones(n, dtype=bool)
        begin[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        begin[off[:-1][off[:-1] < n]] = True
        all_starts = np.flatnonzero(begin)
        all_ends = np.append(all_starts[1:], n)
        keep = kind[all_starts] > 0
        starts, ends = all_starts[keep], all_ends[keep]
        first = np.searchsorted(starts, off)
        numbers = np.zeros(0, np.int64)
        if len(starts):
            h = self.roller.spans(low, starts, ends)
            _, which, inverse = np.unique(h, return_index=True, return_inverse=True)
            owner_simple = np.repeat(simple, np.diff(first))
            use = np.flatnonzero(np.bincount(inverse[owner_simple], minlength=len(which)))
            if len(self.known) > CACHE_PIECES:
                self.clear()
            buffer, known = low.tobytes(), self.known
            pieces = [buffer[a:b] for a, b in zip(starts[which[use]].tolist(), ends[which[use]].tolist())]
            found = [known.get(p) for p in pieces]
            number = np.zeros(len(which), np.int64)
            number[use] = [self._learn(p) if k is None else k for p, k in zip(pieces, found)]
            numbers = number[inverse]
        count = self.count[numbers] if len(numbers) else np.zeros(0, np.int64)
        stops = np.cumsum(count)
        total = int(stops[-1]) if len(stops) else 0
        place = np.repeat((self.at[numbers] if len(numbers) else stops) - (stops - count), count) + np.arange(total)
        flat = self.ids[place]
        edges = np.concatenate([[0], stops])[first]
        for i in range(len(texts)):
            if simple[i]:
                out[i] = flat[edges[i] : edges[i + 1]]
            else:
                out[i] = self._whole(texts, i)
        return out

    def _whole(self, texts: Texts, i: int) -> np.ndarray:
        raw = texts.raw(i).decode("utf-8", "replace")
        return np.array(self.tokenizer.encode(raw, add_special_tokens=False).ids, np.uint32)


def tokenizer_of(path: str) -> TextTokenizer:
    cache = process_cache("tokenizer")
    if cache.get("tokenizer_path") != path:
        cache["tokenizer"], cache["tokenizer_path"] = TextTokenizer(path), path
    return cache["tokenizer"]


# ---------------------------------------------------------------- packing


@dataclass
class Piece:
    doc: int  #: number of the document in the buffer
    start: int
    length: int


def powers(n: int) -> list[int]:
    """n as a sum of falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def split_at(pieces: list[Piece], sizes: list[int]) -> Iterator[tuple[int, list[Piece]]]:
    """The pieces' tokens in order, re-cut into sequences of the given sizes (their sum is the pieces')."""
    queue = list(reversed(pieces))
    for size in sizes:
        row, room = [], size
        while room:
            p = queue.pop()
            if p.length > room:
                queue.append(Piece(p.doc, p.start + room, p.length - room))
                p = Piece(p.doc, p.start, room)
            row.append(p)
            room -= p.length
        yield size, row


def pack(lengths: list[int], tiers: tuple[int, ...]) -> list[tuple[int, list[Piece]]]:
    """Sequences (size, pieces) that hold every token of documents of the given lengths exactly once, unpadded."""
    tiers = tuple(sorted(tiers, reverse=True))
    longest = tiers[0]
    done: list[tuple[int, list[Piece]]] = []
    routed: dict[int, list[Piece]] = {t: [] for t in tiers}
    for doc, n in enumerate(lengths):
        full = n - n % longest
        done.extend((longest, [Piece(doc, at, longest)]) for at in range(0, full, longest))
        if rest := n - full:
            routed[next(t for t in reversed(tiers) if rest <= t)].append(Piece(doc, full, rest))
    # All shorter pieces stand in one list, by length; longer tiers take from it first.
    pool = sorted(((p.length, k, p) for k, p in enumerate(q for t in tiers[1:] for q in routed[t])), key=lambda x: x[:2])
    serial = len(pool)
    open_rows: list[Piece] = []

    def fill(room: int) -> list[Piece]:
        nonlocal serial
        row = []
        while room and pool:
            at = bisect_right(pool, (room, 1 << 60))
            if at:
                length, _, p = pool.pop(at - 1)
            else:  # nothing fits whole: cut the shortest
                length, _, p = pool.pop(0)
                insort(pool, (length - room, serial, Piece(p.doc, p.start + room, length - room)))
                serial += 1
                p = Piece(p.doc, p.start, room)
            row.append(p)
            room -= p.length
        return row

    for p in sorted(routed[longest], key=lambda p: (-p.length, p.doc)):
        row = [p, *fill(longest - p.length)]
        if sum(x.length for x in row) == longest:
            done.append((longest, row))
        else:
            open_rows.extend(row)
    for tier in tiers[1:]:
        # Pieces of this tier that no longer window took open windows of their own size.
        while pool and (pool[-1][0] > tier // 2 or tier == tiers[-1]):
            _, _, p = pool.pop()
            row = [p, *fill(tier - p.length)]
            if sum(x.length for x in row) == tier:
                done.append((tier, row))
            else:
                open_rows.extend(row)
    total = sum(p.length for p in open_rows)
    done.extend(split_at(open_rows, [longest] * (total // longest) + powers(total % longest)))
    return done


def packed(docs: DataFrame, cfg: PackingConfig) -> DataFrame:
    """One row per piece of every row of (doc_id, text); see SCHEMA."""
    if any(t & (t - 1) for t in cfg.tiers) or cfg.step_tokens % max(cfg.tiers):
        raise ValueError("tiers must be powers of two, and step_tokens a multiple of the longest")
    made = "part long, nth long"  # the task, and the sequence's number among those of its size there

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = tokenizer_of(cfg.tokenizer)
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        base = part << 36
        serial, dealt = 0, dict.fromkeys((1 << b for b in range(32)), 0)
        ids: list = []
        tokens: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal serial
            cols: list[list] = [[] for _ in range(10)]
            for size, row in pack([len(t) for t in tokens], cfg.tiers):
                offset = 0
                for p in row:
                    t = tokens[p.doc]
                    crc = zlib.crc32(t[p.start : p.start + p.length].astype("<u4").tobytes())
                    for c, v in zip(cols, (ids[p.doc], p.start, p.length, crc, len(t), base + serial, offset, size,
                                           part, dealt[size])):
                        c.append(v)
                    offset += p.length
                dealt[size] += 1
                serial += 1
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64(), pa.int64()]
            names = [x.split()[0] for x in f"{PIECES}, {made}".split(", ")]
            ids.clear()
            tokens.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        held, run_rows, run_bytes, rows = 0, 0, 0, 0
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for t in text_slices(batch.column("text"), ENCODE_BYTES):
                for i, (x, size) in enumerate(zip(encoder.encode(t), np.diff(t.offsets).tolist())):
                    if rows == RUN_ROWS or (run_rows and run_bytes + size > RUN_BYTES):
                        rows, run_rows, run_bytes = rows % RUN_ROWS, 0, 0
                        if len(ids) >= cfg.buffer_docs or held > 1 << 23:
                            held = 0
                            yield flush()
                            release_memory()
                    rows, run_rows, run_bytes = rows + 1, run_rows + 1, run_bytes + size
                    ids.append(keys[t.lo + i])
                    tokens.append(np.append(x, np.uint32(cfg.end_id)))
                    held += len(x)
        if ids:
            yield flush()

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(leased("tokenizer", run), f"{PIECES}, {made}")
    return step_groups(materialise(docs.sparkSession, pieces, "packed"), cfg.step_tokens)


def step_groups(pieces: DataFrame, step_tokens: int) -> DataFrame:
    """The pieces with their sequence's step group, in place of (part, nth).

    A group of one size is numbered n * 2^32 + size, a mixed one n * 2^32.
    """
    spark = pieces.sparkSession
    counts = pieces.where("offset = 0").groupBy("part", "tier").agg(F.count("*").alias("n"))  # a row a task and size
    totals = sorted(((r.tier, r.n) for r in counts.groupBy("tier").agg(F.sum("n").alias("n")).collect()), reverse=True)
    rows, lead = [], 0  # at most one for each power of two
    for tier, n in totals:
        full = n * tier // step_tokens * (step_tokens // tier)  # sequences in full groups of this size
        rows.append((tier, full, lead))
        lead += (n - full) * tier
    sizes = F.broadcast(spark.createDataFrame(rows, "tier int, full long, lead long"))
    before = F.sum("n").over(Window.partitionBy("tier").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", "tier", F.coalesce(before, F.lit(0)).alias("before"))
    number, own = F.expr("before + nth"), F.expr(f"shiftleft((before + nth) * tier div {step_tokens}, 32) + tier")
    mixed = F.expr(f"shiftleft((lead + (before + nth - full) * tier) div {step_tokens}, 32)")
    return pieces.join(offsets, ["part", "tier"]).join(sizes, "tier").select(
        *(x.split()[0] for x in PIECES.split(", ")), F.when(number < F.col("full"), own).otherwise(mixed).alias("step_group")
    )
