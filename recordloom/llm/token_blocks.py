"""Token ids in compressed blocks: an adaptive context-mixing range coder over independent blocks."""

from __future__ import annotations

import os
import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from recordloom.llm.tables import Scratch, texts
from recordloom.llm.words import slices

#: Size of the Arrow batches in which texts go to Python.
BATCH_BYTES = 4 << 20
END_ID = 2
#: A block closes at the first document's end after so many ids; it is coded in parallel lanes.
BLOCK_IDS, LANES = 1 << 17, 512
#: Ids, and blocks, coded together; the arrays of a step span the lanes of all their blocks.
BATCH_IDS, BATCH_BLOCKS = 1 << 20, 16
ALPHABET = 1 << 16
CACHE_WORDS = 400_000

MAGIC = b"IDBLOCK1"
_HEAD = struct.Struct("<8sIIHI")  # magic, ids, documents, lanes, checksum of the ids
_UNIT, _UNITS = 20, 16  # probabilities: 16 units of 2^20, of which order 0 has at least one
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 40)
_BITS2, _BITS1 = 15, 13


# ---------------------------------------------------------------- tokens


class WordTokenizer:
    """Ids of whole texts. The file's tokenizer never joins characters across white space, so each
    word is encoded once by the library and kept; the store is emptied when it is full.

    Words that differ only in what the tokenizer takes no notice of share their core: ASCII case,
    where it folds case, and closing punctuation, where it sets that apart. Words of letters alone
    are told apart in the library's output by the mark at the end of a word, if the model has one.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.mark = "<|endoftext|>"
        self.mark_id = self.library.token_to_id(self.mark)
        self.known: dict[bytes, bytes] = {}
        self.folds = all(self._ids(c) == self._ids(c.lower()) for c in string.ascii_uppercase)
        cut = self.library.pre_tokenizer
        self.parts = cut is not None and all(len(cut.pre_tokenize_str(x + c)) == 2 for x in string.ascii_letters + string.digits for c in ".,;:!?")
        suffix = getattr(self.library.model, "end_of_word_suffix", None)
        last = [(t, i) for t, i in self.library.get_vocab().items() if suffix and t.endswith(suffix)]
        self.closes = None
        if sum(len(t) == len(suffix) + 1 for t, _ in last) >= 256:  # every byte can end a word
            self.closes = np.zeros(self.library.get_vocab_size(), dtype=bool)
            self.closes[[i for _, i in last]] = True

    def _ids(self, text: str) -> list[int]:
        return self.library.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _core(self, word: bytes) -> tuple[bytes, bytes]:
        """The part that is encoded for all words like this one, and the closing punctuation."""
        if b"<|" in word:
            return word, b""
        core = word.rstrip(b".,;:!?") if self.parts else word
        if not core[-1:].isalnum():
            core = word
        return (core.lower() if self.folds and core.isascii() else core), word[len(core):]

    def _learn(self, new: list[bytes]) -> None:
        marked = new
        if self.closes is not None:
            letters, marked = [], []
            for w in new:
                (letters if w.decode().isalpha() else marked).append(w)
            for i in range(0, len(letters), 500):
                own = letters[i:i + 500]
                ids = np.array(self._ids(b" ".join(own).decode()), dtype="<u4")
                ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
                if len(ends) != len(own):  # a letter that the tokenizer takes apart
                    marked += own
                    continue
                data, ends = ids.tobytes(), ends.tolist()
                self.known.update(zip(own, map(data.__getitem__, map(slice, [0] + ends[:-1], ends))))
        plain = [w for w in marked if b"<|" not in w]
        for i in range(0, len(plain), 500):
            own = plain[i:i + 500]
            ids = np.array(self._ids(self.mark.join(w.decode() for w in own)), dtype="<u4")
            at, data = (np.flatnonzero(ids == self.mark_id) * 4).tolist(), ids.tobytes()
            self.known.update(zip(own, map(data.__getitem__, map(slice, [0] + [x + 4 for x in at], at + [len(data)]))))
        for w in marked:
            if b"<|" in w:
                self.known[w] = np.array(self._ids(w.decode()), dtype="<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [t.split() for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        new = set().union(*split) - known.keys() if split else set()
        if new:
            cores = {w: self._core(w) for w in new}
            self._learn(sorted({x for pair in cores.values() for x in pair if x and x not in known}))
            for w, (core, rest) in cores.items():
                if core != w:
                    known[w] = known[core] + known[rest] if rest else known[core]
        find = known.__getitem__
        return [b"".join(map(find, words)) for words in split]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


# ---------------------------------------------------------------- coder


#: The run of a memory (up to 7) after a miss, then after a hit.
_NEXT_RUN = np.array([1, 1, 1, 1, 2, 2, 3, 3, 1, 2, 3, 4, 5, 6, 7, 7], dtype=np.int8)


class _Mixer:
    """Adaptive predictions of all lanes of some blocks, alike in the coder and the decoder.

    Order 2 and order 1 remember, per hashed context, one id that followed and how often in a
    row; they predict that id alone, not a distribution. How far such a memory is trusted is
    learned per block. What they leave goes to order 0, whose frequencies are counted anew at
    growing intervals. The lanes of a block run side by side and share its memory; another
    block starts from nothing.
    """

    def __init__(self, block: np.ndarray, n_blocks: int):
        self.n = n_blocks
        self.base2, self.base1, self.base0, self.trust = block << _BITS2, block << _BITS1, block * (ALPHABET + 1), block * 8
        self.offset = block << _UNIT
        self.id2, self.id1 = np.zeros(n_blocks << _BITS2, dtype=np.int32), np.zeros(n_blocks << _BITS1, dtype=np.int32)
        self.run2, self.run1 = np.zeros(len(self.id2), dtype=np.int8), np.zeros(len(self.id1), dtype=np.int8)
        self.tried, self.right = np.full((2, n_blocks * 8), 1.0), np.full((2, n_blocks * 8), 0.4)
        self.counts = np.full((n_blocks, ALPHABET), 1, dtype=np.int32)
        #: Where each id begins among the 2^20 units of its block, blocks one after another.
        self.low = np.zeros((n_blocks, ALPHABET + 1), dtype=np.int32 if n_blocks < 1 << 11 else np.int64)
        self.flat = self.low.reshape(-1)
        self.seen: list[np.ndarray] = []
        self.before = np.zeros((2, len(block)), dtype=np.int64)
        self.step, self.next = 0, 2
        self._count()

    def _count(self) -> None:
        """Order-0 frequencies that add up to 2^20 in each block, none zero."""
        if self.seen:
            times = np.bincount(np.concatenate(self.seen), minlength=self.flat.size).reshape(self.low.shape)
            self.counts += 24 * times[:, :ALPHABET].astype(np.int32)
            self.seen = []
        for b in range(self.n):
            scale = ((1 << _UNIT) - ALPHABET) / int(self.counts[b].sum(dtype=np.int64))
            share = np.multiply(self.counts[b], scale, dtype=np.float64).astype(self.low.dtype)
            share += 1
            share[share.argmax()] += (1 << _UNIT) - int(share.sum(dtype=np.int64))
            share[0] += b << _UNIT
            self.low[b, 0] = b << _UNIT
            np.cumsum(share, out=self.low[b, 1:])

    def _mixtures(self) -> tuple[np.ndarray, np.ndarray]:
        """Units of order 0 and share of order 2 by block and runs, then by block and run where both orders agree."""
        rate = self.right / self.tried
        share2 = rate[0].reshape(self.n, 8, 1)
        share1 = (1 - share2) * rate[1].reshape(self.n, 1, 8)
        units = np.clip(np.ceil((1 - share2 - share1) * _UNITS), 1, _UNITS - 1).astype(np.int64)
        guessed = (_UNITS - units) << _UNIT
        part2 = np.clip((guessed * (share2 / (share2 + share1))).astype(np.int64), 1, guessed - 1)
        alone = np.clip(np.ceil((1 - rate[0]) * _UNITS), 1, _UNITS - 1).astype(np.int64)
        return np.concatenate((units.reshape(-1), alone)), np.concatenate((part2.reshape(-1), (_UNITS - alone) << _UNIT))

    def predict(self, n: int) -> None:
        """For the first ``n`` lanes: both predicted ids and the shares of the three orders."""
        if self.step == self.next:
            self._count()
            self.next = self.step + min(128, max(2, self.step))
        h = self.before[0, :n] * 0x2F0B4C47
        self.at2 = self.base2[:n] + (((h + self.before[1, :n] * 0x1B873593) >> 7) & ((1 << _BITS2) - 1))
        self.at1 = self.base1[:n] + ((h >> 9) & ((1 << _BITS1) - 1))
        self.guess2, self.guess1 = self.id2[self.at2], self.id1[self.at1]
        self.r2, self.r1 = self.run2[self.at2], self.run1[self.at1]
        self.trust2, self.trust1 = self.trust[:n] + self.r2, self.trust[:n] + self.r1
        units, part2 = self._mixtures()
        mix = np.where(self.guess1 == self.guess2, self.n * 64 + self.trust2, self.trust2 * 8 + self.r1)
        self.units, self.part2 = units[mix], part2[mix]
        self.guessed = (_UNITS - self.units) << _UNIT

    def update(self, ids: np.ndarray, hit2: np.ndarray, hit1: np.ndarray) -> None:
        """Take in the ids of this step and which of them the orders predicted."""
        n = len(ids)
        missed = ~hit2
        size = self.n * 8
        self.tried[0] += np.bincount(self.trust2, minlength=size)
        self.right[0] += np.bincount(self.trust2[hit2], minlength=size)
        self.tried[1] += np.bincount(self.trust1[missed], minlength=size)
        self.right[1] += np.bincount(self.trust1[missed & hit1], minlength=size)
        for memory, run, at, r, hit in ((self.id2, self.run2, self.at2, self.r2, hit2), (self.id1, self.run1, self.at1, self.r1, hit1)):
            weak = np.flatnonzero(~hit & (r <= 1))
            memory[at[weak]] = ids[weak]
            run[at] = _NEXT_RUN[r + (hit << np.int8(3))]
        self.seen.append(self.base0[:n] + ids)
        self.before[1, :n] = self.before[0, :n]
        self.before[0, :n] = ids
        self.step += 1


def _settled(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes whose leading 16 bits can go, and the sizes cut so that they do not change any more."""
    same = (low ^ (low + size)) < _TOP
    short = ~same & (size < _BOTTOM)
    return np.flatnonzero(same | short), np.where(short, (~low + np.uint64(1)) & (_BOTTOM - np.uint64(1)), size)


def _layout(sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Lanes of all blocks, longest first: block, first id in the block, length; and lanes per block."""
    block, first, length, lanes = [], [], [], []
    for b, n in enumerate(sizes):
        k = max(1, min(LANES, n // 64))
        edges = np.linspace(0, n, k + 1).astype(np.int64)
        block.append(np.full(k, b))
        first.append(edges[:-1])
        length.append(np.diff(edges))
        lanes.append(k)
    block, first, length = map(np.concatenate, (block, first, length))
    order = np.argsort(-length, kind="stable")
    return block[order], first[order], length[order], lanes


def encode_blocks(blocks: list[np.ndarray]) -> list[list[bytes]]:
    """The coded lanes of each block of ids, in lane order."""
    block, first, length, lanes = _layout([len(b) for b in blocks])
    base = np.concatenate(([0], np.cumsum([len(b) for b in blocks])))[block] + first
    ids = np.concatenate(blocks).astype(np.int64) if blocks else np.zeros(0, np.int64)
    if len(ids) and ids.max() >= ALPHABET:
        raise ValueError(f"ids of blocks must be below {ALPHABET}")
    mixer = _Mixer(block, len(blocks))
    low, size = np.zeros(len(block), dtype=np.uint64), np.full(len(block), np.uint64(0xFFFFFFFFFFFFFFFF))
    out_lane: list[np.ndarray] = []
    out_word: list[np.ndarray] = []
    everyone = np.arange(len(block))
    for t in range(int(length[0]) if len(length) else 0):
        n = int(np.searchsorted(-length, -t, side="left"))
        mixer.predict(n)
        own = ids[base[:n] + t]
        is2, is1 = own == mixer.guess2, own == mixer.guess1
        at0 = mixer.base0[:n] + own
        low0 = mixer.flat[at0]
        start = np.where(is2, 0, np.where(is1, mixer.part2, mixer.guessed + mixer.units * (low0 - mixer.offset[:n])))
        width = np.where(is2, mixer.part2, np.where(is1, mixer.guessed - mixer.part2, mixer.units * (mixer.flat[at0 + 1] - low0)))
        unit = size[:n] >> np.uint64(24)
        low[:n] += unit * start.astype(np.uint64)
        size[:n] = unit * width.astype(np.uint64)
        todo, a, s = everyone[:n], low[:n], size[:n]
        while len(todo):
            go, s = _settled(a, s)
            todo, a, s = todo[go], a[go], s[go]
            out_lane.append(todo)
            out_word.append((a >> np.uint64(48)).astype("<u2"))
            a, s = a << np.uint64(16), s << np.uint64(16)
            low[todo], size[todo] = a, s
        mixer.update(own, is2, is1)
    for shift in (48, 32, 16, 0):
        out_lane.append(everyone)
        out_word.append(((low >> np.uint64(shift)) & np.uint64(0xFFFF)).astype("<u2"))
    lane, word = np.concatenate(out_lane), np.concatenate(out_word)
    order = np.argsort(lane, kind="stable")
    pieces = np.split(word[order], np.cumsum(np.bincount(lane, minlength=len(block)))[:-1])
    place = np.lexsort((first, block))
    flat = [pieces[i].tobytes() for i in place]
    edges = np.concatenate(([0], np.cumsum(lanes)))
    return [flat[a:b] for a, b in zip(edges[:-1], edges[1:])]


def decode_blocks(sizes: list[int], coded: list[list[bytes]]) -> list[np.ndarray]:
    """The ids of each block from its coded lanes."""
    block, first, length, _ = _layout(sizes)
    place = np.lexsort((first, block))
    flat = [lane for lanes in coded for lane in lanes]
    lanes: list[bytes] = [b""] * len(block)
    for i, data in zip(place, flat):
        lanes[i] = data
    words = np.frombuffer(b"".join(lanes) + b"\0" * 16, dtype="<u2").astype(np.uint64)
    at = np.concatenate(([0], np.cumsum([len(x) // 2 for x in lanes])))[:-1].astype(np.int64)
    base = np.concatenate(([0], np.cumsum(sizes)))[block] + first
    out = np.zeros(int(sum(sizes)), dtype=np.int64)
    mixer = _Mixer(block, len(sizes))
    low, size = np.zeros(len(block), dtype=np.uint64), np.full(len(block), np.uint64(0xFFFFFFFFFFFFFFFF))
    code = np.zeros(len(block), dtype=np.uint64)
    for _ in range(4):
        code = (code << np.uint64(16)) | words[at]
        at += 1
    everyone = np.arange(len(block))
    for t in range(int(length[0]) if len(length) else 0):
        n = int(np.searchsorted(-length, -t, side="left"))
        mixer.predict(n)
        unit = size[:n] >> np.uint64(24)
        target = np.minimum((code[:n] - low[:n]) // unit, np.uint64((1 << 24) - 1)).astype(np.int64)
        by2 = target < mixer.part2
        own = np.where(by2, mixer.guess2, mixer.guess1).astype(np.int64)
        start = np.where(by2, 0, mixer.part2)
        width = np.where(by2, mixer.part2, mixer.guessed - mixer.part2)
        rest = np.flatnonzero(target >= mixer.guessed)
        units, guessed, offset = mixer.units[rest], mixer.guessed[rest], mixer.offset[rest]
        spot = (target[rest] - guessed) // units + offset
        found = np.searchsorted(mixer.flat, spot.astype(mixer.flat.dtype), side="right") - 1
        low0 = mixer.flat[found]
        own[rest] = found - mixer.base0[rest]
        start[rest] = guessed + units * (low0 - offset)
        width[rest] = units * (mixer.flat[found + 1] - low0)
        low[:n] += unit * start.astype(np.uint64)
        size[:n] = unit * width.astype(np.uint64)
        todo, a, s = everyone[:n], low[:n], size[:n]
        while len(todo):
            go, s = _settled(a, s)
            todo, a, s = todo[go], a[go] << np.uint64(16), s[go] << np.uint64(16)
            low[todo], size[todo] = a, s
            code[todo] = (code[todo] << np.uint64(16)) | words[at[todo]]
            at[todo] += 1
        out[base[:n] + t] = own
        mixer.update(own, own == mixer.guess2, own == mixer.guess1)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    return [out[a:b] for a, b in zip(edges[:-1], edges[1:])]


# ---------------------------------------------------------------- block format


def pack(names: list[int | None], sizes: list[int], ids: np.ndarray, lanes: list[bytes]) -> bytes:
    """One self-contained block: header, document table, lane lengths, lanes and a checksum of it all."""
    body = b"".join([
        _HEAD.pack(MAGIC, len(ids), len(names), len(lanes), zlib.crc32(ids.astype("<u4").tobytes())),
        np.array([n or 0 for n in names], dtype="<i8").tobytes(), np.array([n is None for n in names], dtype=np.uint8).tobytes(),
        np.array(sizes, dtype="<u4").tobytes(), np.array([len(x) for x in lanes], dtype="<u4").tobytes(), *lanes,
    ])
    return body + struct.pack("<I", zlib.crc32(body))


def unpack(block: bytes) -> tuple[list[int | None], np.ndarray, int, int, list[bytes]]:
    """Names, sizes, number of ids, their checksum and the lanes; raises on a damaged block."""
    if len(block) < _HEAD.size + 4 or block[:8] != MAGIC or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("damaged block of token ids")
    _, n, docs, lanes, check = _HEAD.unpack_from(block)
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        got = np.frombuffer(block, dtype=kind, count=count, offset=at)
        at += got.nbytes
        return got

    name, null, size, length = take("<i8", docs), take("u1", docs), take("<u4", docs), take("<u4", lanes)
    pieces = []
    for k in length.tolist():
        pieces.append(block[at:at + k])
        at += k
    return [None if x else int(v) for v, x in zip(name, null)], size.astype(np.int64), n, check, pieces


def write_blocks(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Encode all texts in ascending order of id (null first, ties by the text's hash) into blocks.

    Returns the stored table ``shard, block, before, n_ids, data``: Spark writes and commits it in
    the shared folder, so a lost executor costs only its tasks. Documents are dealt out by ranges
    of the id; shard numbers ascend with them. A document lies in one block.
    """
    rows = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, tail = tokenizer(path), struct.pack("<I", end_id)
        shard = TaskContext.get().partitionId()
        ready: list[tuple[list, list, np.ndarray]] = []
        names, parts, count = [], [], 0
        number, before = 0, 0

        def close() -> None:
            nonlocal names, parts, count
            if names:
                ready.append((names, [len(p) // 4 for p in parts], np.frombuffer(b"".join(parts), dtype="<u4")))
            names, parts, count = [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal number, before
            rows = []
            for (name, size, ids), lanes in zip(ready, encode_blocks([r[2] for r in ready])):
                rows.append((shard, number, before, len(ids), pack(name, size, ids, lanes)))
                number, before = number + 1, before + len(ids)
            ready.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))], names=["shard", "block", "before", "n_ids", "data"]
            )

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for part in slices(batch.column("text")):
                data, edges = part.raw.tobytes(), part.offsets.tolist()
                coded = tok.encode([data[a:b] for a, b in zip(edges[:-1], edges[1:])])
                for i, x in enumerate(coded):
                    names.append(ids[part.first + i])
                    parts.append(x + tail)
                    count += len(x) // 4 + 1
                    if count >= BLOCK_IDS:
                        close()
                    if sum(len(r[2]) for r in ready) >= BATCH_IDS:
                        yield flush()
        close()
        if ready:
            yield flush()
        tok.known.clear()  # a worker outlives its task, its words need not

    coded = dealt.select("doc_id", "text").mapInArrow(encode, "shard int, block int, before long, n_ids long, data binary")
    return Scratch(docs.sparkSession, BATCH_BYTES).cut(coded, "llm-token-blocks")


def read_blocks(stored: DataFrame, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (and ``ids``) of each document from the stored blocks.

    The ids before a shard are a running sum over one row per shard.
    """
    shards = stored.groupBy("shard").agg(F.sum("n_ids").alias("sum"))
    order = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("sum").over(order), F.lit(0)).alias("ahead"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group: list[tuple] = []
            for i in range(batch.num_rows):
                group.append((batch.column("shard")[i].as_py(), batch.column("before")[i].as_py(), *unpack(batch.column("data")[i].as_py())))
                if i + 1 == batch.num_rows or len(group) == BATCH_BLOCKS or sum(g[4] for g in group) >= BATCH_IDS:
                    yield rows(group)
                    group = []

    def rows(group: list[tuple]) -> pa.RecordBatch:
        out: list[list] = [[] for _ in range(6)]
        for (shard, before, names, sizes, _, check, _), ids in zip(group, decode_blocks([g[4] for g in group], [g[6] for g in group])):
            data = ids.astype("<u4").tobytes()
            if zlib.crc32(data) != check:
                raise ValueError("token ids do not match their checksum")
            edges = np.concatenate(([0], np.cumsum(sizes))).tolist()
            for name, a, b in zip(names, edges[:-1], edges[1:]):
                for column, value in zip(out, (shard, name, before + a, b - a, zlib.crc32(data[4 * a:4 * b]), ids[a:b] if with_ids else None)):
                    column.append(value)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, kinds)], names=["shard", "doc_id", "at", "n_tokens", "ids_crc32", "ids"])

    found = stored.select("shard", "before", "data").mapInArrow(decode, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long, ids array<long>")
    joined = found.join(F.broadcast(shards), "shard").select("doc_id", (F.col("ahead") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "ids")
    return joined if with_ids else joined.drop("ids")


def token_ids(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """Write all texts as blocks, read them back and describe each document.

    Returns ``doc_id, start, n_tokens, ids_crc32``. Null text counts as empty and has only the end
    id. Null ids come first; rows that repeat an id follow each other, each with its own place.
    An empty table gives no rows. Other columns are ignored.
    """
    return read_blocks(write_blocks(docs, path, end_id))
