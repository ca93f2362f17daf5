"""BPE encoding and decoding with a published vocabulary.

Each distinct word is merged with a segment tree over the ranks of its adjacent
pairs: a leaf holds ``rank * leaves + position``, a node the minimum of its two
children, so the root names the leftmost pair of lowest rank.  A merge updates
three leaves and their ancestors (logarithmic), until the root holds no pair.
Words of a chunk with equally large trees are merged together, one numpy step
for the current merge of each of them.

Text handling follows the vocabulary file: Unicode NFC, white space to single
spaces, per-character lower case, pieces by the file's pattern, bytes to the
file's alphabet, a word-end mark on the last symbol; the strings of the special
tokens are recognised in the raw text.

Defined cases: null or empty texts give no ids and an empty decoded text;
repeated rows are encoded alike; extra columns are ignored; ids decode to the
token strings joined by one space (the file names no decoder).
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_batches, widened
from .textbuf import buffers, chunks, ranges

CHUNK = 2 << 20
CACHED_WORDS = 200_000
MAX_VOCABULARY_BYTES = 64 << 20
_NONE = np.int64(2**62)


# Lower-case letters that came with Unicode 16 and 17, which the
# library's lower-casing knows: (first capital, last, distance to the small letter).
NEW_CAPITALS = (
    (0x1C89, 0x1C89, 1),
    (0xA7CB, 0xA7CB, 0x264 - 0xA7CB),
    (0xA7CC, 0xA7CC, 1),
    (0xA7CE, 0xA7CE, 1),
    (0xA7D2, 0xA7D2, 1),
    (0xA7D4, 0xA7D4, 1),
    (0xA7DA, 0xA7DA, 1),
    (0xA7DC, 0xA7DC, 0x19B - 0xA7DC),
    (0x10D50, 0x10D65, 0x20),
    (0x16EA0, 0x16EB8, 0x1B),
)

# Letters and numbers (first, last) that Unicode 16, the version of
# the library's classes, has beyond those of ``unicodedata``.
NEW_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NEW_NUMBERS = (
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)
LOWER = {c: c + by for a, b, by in NEW_CAPITALS for c in range(a, b + 1)}
CHARACTERS = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))


NEW_CAPITAL = regex.compile("[" + "".join(map(chr, LOWER)) + "]")


def late_characters() -> frozenset[str]:
    """Letters and numbers of ``regex``, built for a later Unicode, that the
    library's engine does not know as such."""
    known = {c for a, b in (*NEW_LETTERS, *NEW_NUMBERS) for c in range(a, b + 1)}
    return frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", CHARACTERS)
                     if unicodedata.category(c) == "Cn" and ord(c) not in known)


def without(pattern: str, characters: frozenset[str]) -> regex.Pattern:
    """The pattern with ``characters`` taken out of its letters and numbers."""
    if not characters:
        return regex.compile(pattern)
    out = "".join(f"\\U{ord(c):08x}" for c in sorted(characters))
    for kind in ("L", "N"):
        pattern = pattern.replace(rf"\p{{{kind}}}", rf"[\p{{{kind}}}--[{out}]]")
    return regex.compile(pattern, regex.V1)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level files."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class PairRanks:
    """(left id, right id) -> (rank, merged id) for arrays of pairs."""

    def __init__(self, pairs: list[tuple[int, int, int]], size: int):
        left, right, merged = (np.array(x, dtype=np.int64) for x in zip(*pairs, strict=True)) if pairs else (
            np.zeros(0, np.int64),) * 3
        self.size = size
        key = left * size + right
        # the first of equal pairs counts
        self.keys, self.rank = np.unique(key, return_index=True)
        self.rank = self.rank.astype(np.int64)
        self.merged = merged

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks; a large number where the pair is no merge."""
        if not len(self.keys):
            return np.full(len(left), _NONE)
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.rank[at], _NONE)


def merge_words(symbols: np.ndarray, lengths: np.ndarray, leaves: int, ranks: PairRanks) -> np.ndarray:
    """Merge a batch of words in place.

    symbols: (words, leaves) ids, -1 beyond a word's length.  Returns the same
    array with -1 where a symbol was merged into the one before it."""
    n = len(symbols)
    rows = np.arange(n)
    tree = np.full((n, 2 * leaves), _NONE)
    following = np.tile(np.arange(1, leaves + 1, dtype=np.int64), (n, 1))
    before = np.tile(np.arange(-1, leaves - 1, dtype=np.int64), (n, 1))
    if leaves > 1:
        pair = np.arange(leaves - 1) < (lengths[:, None] - 1)
        r, c = np.nonzero(pair)
        rank = ranks.lookup(symbols[r, c], symbols[r, c + 1])
        found = rank < _NONE
        tree[r[found], leaves + c[found]] = rank[found] * leaves + c[found]
    for node in range(leaves - 1, 0, -1):
        tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])

    def update(row: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
        node = leaf + leaves
        tree[row, node] = value
        node >>= 1
        while len(node) and node[0] >= 1:
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            node >>= 1

    live = rows
    while True:
        live = live[tree[live, 1] < _NONE]
        if not len(live):
            return symbols
        root = tree[live, 1]
        at, rank = root % leaves, root // leaves
        gone = following[live, at]
        after = following[live, gone]
        symbols[live, at] = ranks.merged[rank]
        symbols[live, gone] = -1
        following[live, at] = after
        inner = after < lengths[live]
        before[live[inner], after[inner]] = at[inner]
        update(live, gone, np.full(len(live), _NONE))
        value = np.full(len(live), _NONE)
        new = ranks.lookup(symbols[live[inner], at[inner]], symbols[live[inner], after[inner]])
        value[inner] = np.where(new < _NONE, new * leaves + at[inner], _NONE)
        update(live, at, value)
        left = before[live, at]
        inner = left >= 0
        if inner.any():
            row, p = live[inner], left[inner]
            new = ranks.lookup(symbols[row, p], symbols[row, at[inner]])
            update(row, p, np.where(new < _NONE, new * leaves + p, _NONE))


class BpeCodec:
    """Encoder and decoder built from the bytes of a vocabulary file."""

    def __init__(self, raw: bytes):
        spec = json.loads(raw)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = (regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
                           if self.special else None)
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        # for the few words with such characters: its large classes are slow
        self.late = late_characters()
        self.late_pieces = without(split["pattern"]["Regex"], self.late)
        self.space = regex.compile(r"\s+")
        self.separators = regex.compile("[\x1c-\x1f]")   # white space to str.split() only
        size = 1 + max([*self.vocab.values(), *self.special.values()])
        pairs = []
        for merge in model["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            pairs.append((self.vocab[a], self.vocab[b], self.vocab[a + b]))
        self.ranks = PairRanks(pairs, size)
        alphabet = byte_alphabet()
        self.inner = np.array([self.vocab[c] for c in alphabet], dtype=np.int64)
        self.last = np.array([self.vocab[c + self.suffix] for c in alphabet], dtype=np.int64)
        self.tokens: list[bytes] = [b""] * size
        for token, i in [*self.vocab.items(), *self.special.items()]:
            self.tokens[i] = token.encode()
        self.forget()

    def forget(self) -> None:
        """Drop the words learnt; a worker outlives its task, and the next stage needs the memory."""
        self.known: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.offsets = np.zeros(1, np.int64)

    # ------------------------------------------------------------ encoding
    def normalise(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")   # no final sigma
            if NEW_CAPITAL.search(text):
                text = text.translate(LOWER)
        return text.lower()

    def words(self, text: str) -> list[str]:
        """White-space separated words of one text (no piece holds white space,
        so its kind and length do not matter); a special token stands alone,
        marked."""
        if self.special_re is not None and "<|" in text:
            out, at = [], 0
            for m in self.special_re.finditer(text):
                out += self._split(text[at:m.start()])
                out.append("\0 " + m.group())
                at = m.end()
            return out + self._split(text[at:])
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        text = self.normalise(text)
        if self.separators.search(text):
            return [w for w in self.space.split(text) if w]
        return text.split()

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of distinct words."""
        n = len(words)
        data = [w.encode() for w in words]
        lengths = np.fromiter(map(len, data), np.int64, n)
        trees = np.maximum(1, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        counts = np.zeros(n, np.int64)
        flat_rows, flat_ids = [], []
        for leaves in np.unique(trees):
            leaves = int(leaves)
            group = np.flatnonzero(trees == leaves)
            step = max(1, (1 << 20) // (2 * leaves))
            for lo in range(0, len(group), step):
                part = group[lo:lo + step]
                size = lengths[part]
                raw = np.frombuffer(b"".join(data[i] for i in part), np.uint8)
                row = np.repeat(np.arange(len(part)), size)
                col = ranges(np.zeros(len(part), np.int64), size)
                symbols = np.full((len(part), leaves), -1, np.int64)
                symbols[row, col] = self.inner[raw]
                symbols[np.arange(len(part)), size - 1] = self.last[raw[np.cumsum(size) - 1]]
                merge_words(symbols, size, leaves, self.ranks)
                keep = symbols >= 0
                counts[part] = keep.sum(axis=1)
                flat_rows.append(np.repeat(part, counts[part]))
                flat_ids.append(symbols[keep])
        rows = np.concatenate(flat_rows) if flat_rows else np.zeros(0, np.int64)
        ids = np.concatenate(flat_ids) if flat_ids else np.zeros(0, np.int64)
        order = np.argsort(rows, kind="stable")
        return ids[order].astype(np.uint32), np.concatenate([[0], np.cumsum(counts)])

    def learn(self, words: list[str]) -> None:
        """Merge words not seen before and keep their ids."""
        late = self.late
        pieces = [[w] if w.startswith("\0 ") else
                  (self.pieces if w.isascii() or late.isdisjoint(w) else self.late_pieces).findall(w) for w in words]
        distinct = list(dict.fromkeys(p for ps in pieces for p in ps))
        plain = [p for p in distinct if not p.startswith("\0 ")]
        marks = [p for p in distinct if p.startswith("\0 ")]
        ids, offsets = self.encode_words(plain)
        ids = np.concatenate([ids, np.array([self.special[p[2:]] for p in marks], np.uint32)])
        offsets = np.concatenate([offsets, offsets[-1] + 1 + np.arange(len(marks))])
        place = dict(zip(plain + marks, range(len(distinct)), strict=True))
        index = np.array([place[p] for ps in pieces for p in ps], np.int64)
        count = offsets[index + 1] - offsets[index]
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum([len(ps) for ps in pieces])]
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + ends])
        self.ids = np.concatenate([self.ids, ids[ranges(offsets[index], count)]])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        words = [self.words(t) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.forget()
        known = self.known
        new = list({w for ws in words for w in ws}.difference(known))
        if new:
            self.learn(new)
        out = []
        for ws in words:
            index = np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))
            first = self.offsets[index]
            out.append(self.ids[ranges(first, self.offsets[index + 1] - first)].astype("<u4", copy=False))
        return out

    # ------------------------------------------------------------ decoding
    def decode(self, ids: np.ndarray) -> bytes:
        tokens = self.tokens
        return b" ".join([tokens[i] for i in ids.tolist()])


_CODECS: dict[str, BpeCodec] = {}


def _codec(raw: bytes) -> BpeCodec:
    """One codec per worker process and vocabulary."""
    key = hashlib.sha256(raw).hexdigest()
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = BpeCodec(raw)
    return _CODECS[key]


def vocabulary(spark, path: str):
    """Broadcast the vocabulary file (its size is checked)."""
    with open(path, "rb") as f:
        raw = f.read()
    if len(raw) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: a vocabulary of {len(raw)} bytes is over {MAX_VOCABULARY_BYTES}")
    return spark.sparkContext.broadcast(raw)


def text_chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[list[str]]:
    _, offsets = buffers(column)
    for lo, hi in chunks(offsets, limit):
        yield [t or "" for t in column.slice(lo, hi - lo).to_pylist()]


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with a column ``ids_col`` (array<bigint>) of token ids."""
    raw = vocabulary(docs.sparkSession, path)
    schema = widened(docs.drop(ids_col), ids_col, "array<bigint>")

    def work(batches):
        codec = _codec(raw.value)
        for batch in batches:
            values, ends = [], [0]
            for texts in text_chunks(batch.column(batch.schema.get_field_index(text_col))):
                for ids in codec.encode(texts):
                    values.append(ids)
                    ends.append(ends[-1] + len(ids))
            flat = np.concatenate(values).astype(np.int64) if values else np.zeros(0, np.int64)
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))
            names = [c for c in batch.schema.names if c != ids_col]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in names] + [column],
                                             names=[*names, ids_col])
        codec.forget()

    return in_batches(docs, work, schema)


def decode_documents(docs: DataFrame, path: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text that its token ids decode to; null ids give ''."""
    raw = vocabulary(docs.sparkSession, path)
    schema = widened(docs.drop(out_col), out_col, "string")

    def work(batches):
        codec = _codec(raw.value)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            column = pa.array([codec.decode(np.array(x or [], np.int64)).decode() for x in lists], pa.string())
            names = [c for c in batch.schema.names if c != out_col]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in names] + [column],
                                             names=[*names, out_col])

    return in_batches(docs, work, schema)


def bpe_digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document: each
    text is encoded, the ids are decoded, and both results are digested in the
    same task, so that ids and texts do not travel.  ``with_ids`` adds the ids."""
    raw = vocabulary(docs.sparkSession, path)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids

    def work(batches):
        codec = _codec(raw.value)
        for batch in batches:
            at = 0
            for texts in text_chunks(batch.column(1)):
                n_tokens, ids_sha, text_sha, values = [], [], [], []
                for ids in codec.encode(texts):
                    n_tokens.append(len(ids))
                    ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    text_sha.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                    if with_ids:
                        values.append(ids)
                columns = [batch.column(0).slice(at, len(texts)), pa.array(n_tokens, pa.int64()), pa.array(ids_sha, pa.string()),
                           pa.array(text_sha, pa.string())]
                at += len(texts)
                if with_ids:
                    flat = np.concatenate(values).astype(np.int32) if values else np.zeros(0, np.int32)
                    ends = np.concatenate([[0], np.cumsum(n_tokens)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"][:len(columns)])
        codec.forget()

    return in_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, schema)
