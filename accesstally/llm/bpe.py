"""BPE encoding and decoding with reuse of content-defined chunks.

A rolling hash over the last bytes cuts each text where its value says so, so equal passages of
different documents fall into equal chunks. A chunk's inside, from its first to its last blank, is
encoded once in a task and reused wherever the chunk comes again. What a cut leaves on both sides of
a join, the end of one chunk and the start of the next, is put together and encoded anew, over as
many chunks as it takes to reach a blank on both sides: the tokenizer parts words at blanks, so there
the pieces agree with the encoding of the whole text. Inside chunks words are encoded once as well.

All this needs a tokenizer that parts words at blanks and lower-cases them as ``NORMALIZER`` and
``PRE_TOKENIZER`` say. The definition is compared with these; texts of any other tokenizer are encoded
whole, by the library.

The memories of a task are emptied when they hold ``CHUNK_BYTES`` or ``WORDS``, so memory does not
grow with the corpus. No row leaves its task.

Cases: a null or empty text has no ids and decodes to the empty text. Special tokens' strings in a text
become special tokens, as in the library. Repeated rows are encoded one by one.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from accesstally.llm.workers import importable, released

#: Mean length of a chunk is 2**CUT_BITS bytes; the hash looks at the last REACH bytes.
CUT_BITS, REACH = 9, 16
#: What a task remembers at most: bytes of chunks with their codes, and words (twice that, with the older half).
CHUNK_BYTES, WORDS = 12_000_000, 100_000
#: New words that are encoded at one go.
TOGETHER = 500
#: Rows in a batch that is handed back.
ROWS = 250

#: Stands between words that are encoded together; words that hold it are encoded by themselves.
MARK = "\x01"

#: Words whose pieces are known without the tokenizer's own splitting.
PLAIN = re.compile(r"([A-Za-z]+)([.,;:!?$%&*#|]*)").fullmatch

#: How a tokenizer normalises and parts texts if words between blanks can be encoded alone.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}


def parts_at_blanks(definition: str) -> bool:
    """Whether a tokenizers file encodes a text as its words between blanks, one after the other."""
    known = json.loads(definition)
    model = known["model"]
    plain = known.get("normalizer") == NORMALIZER and known.get("pre_tokenizer") == PRE_TOKENIZER
    plain &= known.get("post_processor") is None and known.get("decoder") is None
    plain &= model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
    for token in known.get("added_tokens", []):
        plain &= not (token["normalized"] or token["lstrip"] or token["rstrip"] or token["single_word"])
        # such a token must lie within one word, and in none that is encoded by its letters
        plain &= bool(token["content"]) and re.search(r"\s", token["content"]) is None
        plain &= re.search(r"[^A-Za-z.,;:!?$%&*#|]", token["content"]) is not None
    return plain


class Coder:
    """Encodes and decodes texts with one tokenizer, remembering words and chunks."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        names = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        self.plain = parts_at_blanks(definition)
        self.names = {i: t.encode() for i, t in names.items()}
        marks = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        self.plain &= len(marks) == 1
        self.mark = marks[0] if marks else None
        self.words: dict[str, tuple[bytes, bytes]] = {}
        self.stems: dict[str, tuple[bytes, bytes]] = {}
        self.marks: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.chunks: dict[str, tuple[bytes, bytes]] = {}
        self.held = 0
        seeds = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
        self.seeds = seeds

    def learn(self, fields: set[str]) -> None:
        """Make sure that all of these words are remembered, encoding the new ones together."""
        new = fields - self.words.keys()
        if len(self.words) + len(new) > WORDS:
            self.older, self.words = self.words, {}
            new = set(fields)
        kept = new & self.older.keys()
        for field in kept:
            self.words[field] = self.older[field]
        new = self.learn_plain(new - kept)
        apart = [f for f in new if MARK in f]
        new = [f for f in new if MARK not in f]
        groups = [new[at : at + TOGETHER] for at in range(0, len(new), TOGETHER)] + [[f] for f in apart]
        between = f" {MARK} "
        codes = self.tokenizer.encode_batch_fast([between.join(g) for g in groups], add_special_tokens=False)
        for group, code in zip(groups, codes, strict=True):
            ids = code.ids
            data = np.array(ids, "<u4").tobytes()
            names = [self.names[i] for i in ids]
            ends = [k for k, i in enumerate(ids) if i == self.mark] if len(group) > 1 else []
            before = 0
            for field, end in zip(group, [*ends, len(ids)], strict=True):
                self.words[field] = (data[4 * before : 4 * end], b" ".join(names[before:end]))
                before = end + 1

    def learn_plain(self, fields: set[str]) -> set[str]:
        """Encode the words that are letters a-z in any case with marks behind; returns the others.

        Such a word is two pieces to the tokenizer, its letters in lower case and its marks, and the
        letters go to the tokenizer's merges directly, once for all spellings.
        """
        rest, tokenize = set(), self.tokenizer.model.tokenize
        for field in fields:
            found = PLAIN(field)
            if found is None:
                rest.add(field)
                continue
            letters, marks = found.groups()
            letters = letters.lower()
            code = self.stems.get(letters)
            if code is None:
                tokens = tokenize(letters)
                code = (np.array([t.id for t in tokens], "<u4").tobytes(), " ".join([t.value for t in tokens]).encode())
                self.stems[letters] = code
            if marks:
                tail = self.marks.get(marks)
                if tail is None:
                    ids = self.tokenizer.encode(marks, add_special_tokens=False).ids
                    tail = self.marks[marks] = (np.array(ids, "<u4").tobytes(), b"".join([b" " + self.names[i] for i in ids]))
                code = (code[0] + tail[0], code[1] + tail[1])
            self.words[field] = code
        for memory in (self.stems, self.marks):
            if len(memory) > WORDS:
                memory.clear()
        return rest

    def coded(self, text: str) -> tuple[bytes, bytes]:
        """Ids and decoded text of a piece with blanks or the text's ends on both sides."""
        words = self.words
        got = [words[f] for f in text.split(" ") if f]
        return b"".join([g[0] for g in got]), b" ".join([g[1] for g in got if g[1]])

    def cuts(self, text: str) -> list[int]:
        """Where chunks end, in characters; the hash runs over the characters' low bytes."""
        if len(text) <= REACH:
            return [len(text)]
        data = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        value = self.seeds[data & np.uint32(255)]
        # sixteen places by doubling: h16[i] = sum of seeds * odd**distance
        for shift, factor in ((1, 0x9E3779B97F4A7C15), (2, 0xBF58476D1CE4E5B9), (4, 0x94D049BB133111EB), (8, 0xD6E8FEB86659FD93)):
            moved = value[:-shift] * np.uint64(factor)
            value = value.copy()
            value[shift:] += moved
        hit = np.flatnonzero((value >> np.uint64(64 - CUT_BITS)) == 0) + 1
        hit = hit[(hit >= REACH) & (hit < len(text))]
        return [*hit.tolist(), len(text)]

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, bytes]]:
        """Ids and decoded text of each."""
        if not self.plain:
            codes = self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
            decoded = [self.tokenizer.decode(c.ids, skip_special_tokens=False) for c in codes]
            return [(np.array(c.ids, "<u4").tobytes(), d.encode()) for c, d in zip(codes, decoded, strict=True)]
        if self.held > CHUNK_BYTES:  # between batches only: what learn() may skip has to stay
            self.chunks.clear()
            self.held = 0
        texts = [(t or "").replace("\n", " ").replace("\t", " ").replace("\r", " ") for t in texts]
        pieces = [self.pieces(t) for t in texts]
        fields: set[str] = set()
        for parts in pieces:
            for piece, inside in parts:
                if not inside or piece not in self.chunks:
                    fields.update(piece.split(" "))
        fields.discard("")
        self.learn(fields)
        return [self.joined(parts) for parts in pieces]

    def pieces(self, text: str) -> list[tuple[str, bool]]:
        """A text's parts between blanks, in order: insides of chunks (True) and joins."""
        out, carry, start = [], "", 0
        for end in self.cuts(text):
            chunk, start = text[start:end], end
            first, last = chunk.find(" "), chunk.rfind(" ")
            if first < 0:  # no blank: the join reaches on into the next chunk
                carry += chunk
                continue
            out.append((carry + chunk[:first], False))
            out.append((chunk[first:last], True))
            carry = chunk[last + 1 :]
        out.append((carry, False))
        return [p for p in out if p[0]]

    def joined(self, parts: list[tuple[str, bool]]) -> tuple[bytes, bytes]:
        codes = []
        for piece, inside in parts:
            code = self.chunks.get(piece) if inside else None
            if code is None:
                code = self.coded(piece)
                if inside:
                    self.held += len(piece) * 2 + len(code[0]) + len(code[1]) + 200
                    self.chunks[piece] = code
            codes.append(code)
        return b"".join([c[0] for c in codes]), b" ".join([c[1] for c in codes if c[1]])


_coders: dict[int, Coder] = {}


def encode(documents: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers) and the text decoded from them, for every row.

    ``path`` is a tokenizers file that the driver can read; its content goes to the tasks.
    """
    with open(path, encoding="utf-8") as file:
        definition = importable(documents.sparkSession).sparkContext.broadcast(file.read())
    out = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def coded(batches):
        key = hash(definition.value)
        if key not in _coders:
            _coders.clear()
            _coders[key] = Coder(definition.value)
        coder = _coders[key]
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                codes = coder.encode(part.column(1).to_pylist())
                columns = [part.column(0), pa.array([c[0] for c in codes], pa.binary()), pa.array([c[1] for c in codes], pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(released(coded), "doc_id long, ids binary, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op3_bpe(spark, sf_dir):
    import public_tokenizers

    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(encode(documents, public_tokenizers.path("word_bpe_49k.json")))
