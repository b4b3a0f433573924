"""SentencePiece BPE encoding by backtracking, and decoding.

A merge-type vocabulary splits a text in one way in which every token, and every two adjacent tokens, come out unchanged when
merged again from characters. The encoder therefore takes the longest piece that starts at a position (found by an Aho-Corasick
automaton), goes to shorter pieces while the new token is not compatible with the one before, and steps back when none is left,
marking the position in a bit field so that it is not tried twice. Compatibility of two tokens is checked once by merging them
again, and kept. Where no piece holds a space mark behind another character, no merge crosses such a place, so the text is cut
there and the ids of a cut-out chunk are kept for its next occurrence.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tamarack.llm.common import tidied

SPACE = "▁"

#: Pairs of tokens that a task keeps at most, and bytes of chunks with their ids (an entry counts at least ENTRY bytes, what Python needs
#: for it); when full, the store begins anew. Bounds memory only.
KEPT, KEPT_BYTES, ENTRY = 250_000, 40 * 2**20, 200


class PieceModel:
    """Pieces, scores and rules of a SentencePiece BPE model file without text normalisation."""

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        with open(path, "rb") as f:
            model = proto.ModelProto.FromString(f.read())
        if model.trainer_spec.model_type != proto.TrainerSpec.BPE:
            raise ValueError("the model is not of the merge type")
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("models that normalise their text are not supported")
        kind = proto.ModelProto.SentencePiece
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.dummy_prefix = spec.add_dummy_prefix
        self.text = [p.piece for p in model.pieces]
        self.bos, self.eos = model.trainer_spec.bos_id, model.trainer_spec.eos_id
        self.unk, self.unk_surface = model.trainer_spec.unk_id, model.trainer_spec.unk_surface
        self.bytes = {int(p.piece[1:-1], 16): n for n, p in enumerate(model.pieces) if p.type == kind.BYTE}
        self.byte_of = {n: b for b, n in self.bytes.items()}
        self.control = {n for n, p in enumerate(model.pieces) if p.type == kind.CONTROL}
        normal = {p.piece: n for n, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == kind.NORMAL}
        self.id = normal
        self.cut_at_space = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in normal)
        self.whole = {p for p in normal if self.merge(p) == [p]}  # the rest never come out of an encoding
        self.pairs: dict[int, bool] = {}
        automaton = ahocorasick.Automaton()
        for p in self.whole:
            automaton.add_word(p, normal[p])
        automaton.make_automaton()
        self.automaton = automaton
        self.size = [len(p) for p in self.text]
        self.shorter: list[int | None] = [None] * len(self.text)
        for p in self.whole:
            self.shorter[normal[p]] = next((normal[p[:k]] for k in range(len(p) - 1, 0, -1) if p[:k] in self.whole), None)
        self.known = frozenset(p for p in self.whole if len(p) == 1)
        plain = [self._plain(n) for n in range(len(self.text))]
        self.flat = np.frombuffer(b"".join(plain), np.uint8)
        self.length = np.array([len(p) for p in plain], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.length)[:-1]])

    def _plain(self, n: int) -> bytes:
        """What an id stands for in a decoded text."""
        if n in self.control:
            return b""
        if n in self.byte_of:
            return bytes([self.byte_of[n]])
        return self.unk_surface.encode() if n == self.unk else self.text[n].replace(SPACE, " ").encode()

    def merge(self, text: str) -> list[str]:
        """The definition: join the adjacent symbols whose union scores best, the leftmost of equals, until none is a piece."""
        symbols = list(text)
        while True:
            best, at = None, -1
            for k in range(len(symbols) - 1):
                score = self.score.get(symbols[k] + symbols[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens come out again when their characters are merged."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT:
                self.pairs.clear()
            a, b = self.text[left], self.text[right]
            known = self.pairs[key] = self.merge(a + b) == [a, b]
        return known

    def _known_run(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces."""
        longest, size, shorter, compatible = self.automaton.iter_long, self.size, self.shorter, self.compatible
        tokens: list[int] = []
        at = 0
        for _, token in longest(text):  # as far as the longest pieces go together
            if tokens and not compatible(tokens[-1], token):
                break
            tokens.append(token)
            at += size[token]
        if at == len(text):
            return tokens
        failed = bytearray(len(text) + 1)
        token = next(longest(text, at))[1]
        while at < len(text):
            last = tokens[-1] if tokens else None
            while token is not None and (failed[at + size[token]] or (last is not None and not compatible(last, token))):
                token = shorter[token]
            if token is None:
                failed[at] = 1
                token = tokens.pop()
                at -= size[token]
                token = shorter[token]
            else:
                tokens.append(token)
                at += size[token]
                token = next(longest(text, at))[1] if at < len(text) else None
        return tokens

    def chunk_ids(self, chunk: str) -> list[int]:
        """Ids of a chunk; characters that are no piece become their UTF-8 bytes."""
        if self.known.issuperset(chunk):
            return self._known_run(chunk)
        out: list[int] = []
        begin = 0
        for k in range(len(chunk) + 1):
            if k == len(chunk) or chunk[k] not in self.known:
                if begin < k:
                    out += self._known_run(chunk[begin:k])
                if k < len(chunk):
                    out += [self.bytes[b] for b in chunk[k].encode()] if self.bytes else [self.unk]
                begin = k + 1
        return out


class Chunks(dict):
    """Packed ids by the chunk's text after its space mark. When full, the store becomes the old one, and what is used moves back."""

    def __init__(self, model: PieceModel):
        super().__init__()
        self.model, self.old, self.held = model, {}, 0

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = np.array(self.model.chunk_ids(SPACE + word), "<u4").tobytes()
        size = ENTRY + 4 * len(word) + len(ids)
        if size > KEPT_BYTES // 16:  # a text without spaces, say: not worth the room
            return ids
        if self.held + size > KEPT_BYTES:
            self.old, self.held = dict(self), 0
            self.clear()
        self[word] = ids
        self.held += size
        return ids


class Encoder:
    """Encodes and decodes texts; keeps the ids of recent chunks as packed little-endian numbers."""

    def __init__(self, path: str):
        self.model = PieceModel(path)
        self.chunks = Chunks(self.model)

    def encode(self, text: str, ends: bool = True) -> np.ndarray:
        """Ids of a text, with the begin and end ids unless ``ends`` is false."""
        m, out = self.model, b""
        if text:
            if m.cut_at_space and m.dummy_prefix and SPACE not in text:
                parts = text.split(" ")
                if "" not in parts:
                    out = b"".join(map(self.chunks.__getitem__, parts))
                    parts = None
            else:
                parts = [""]
            if parts is not None:
                whole = (SPACE if m.dummy_prefix else "") + text.replace(" ", SPACE)
                cut = re.findall(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+", whole) if m.cut_at_space else [whole]
                simple = re.compile(f"{SPACE}[^{SPACE}]").match
                out = b"".join(
                    self.chunks[c[1:]] if simple(c) else np.array(m.chunk_ids(c), "<u4").tobytes() for c in cut
                )
        ids = np.frombuffer(out, "<u4")
        return np.concatenate([[m.bos], ids, [m.eos]]).astype("<u4") if ends else ids

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        """UTF-8 of the text of a sequence of ids.

        Control ids vanish, byte ids are joined to characters, the space of a leading piece that begins with one is dropped, and
        each byte that is part of no character becomes U+FFFD.
        """
        m = self.model
        ids = np.asarray(ids, np.int64)
        sizes = m.length[ids]
        before = np.cumsum(sizes) - sizes
        raw = m.flat[np.repeat(m.begin[ids] - before, sizes) + np.arange(sizes.sum())].tobytes()
        first = next((n for n in ids[:16].tolist() if n not in m.control), None)
        if first is None:
            first = next((n for n in ids.tolist() if n not in m.control), m.unk)
        if m.dummy_prefix and first != m.unk and first not in m.byte_of and m.text[first].startswith(SPACE):
            raw = raw[1:]
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return _repaired(raw)

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_bytes(ids).decode()


def _repaired(raw: bytes) -> bytes:
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                raw[at : at + n].decode()
            except UnicodeDecodeError:
                continue
            out.append(raw[at : at + n])
            at += n
            break
        else:
            out.append("\ufffd".encode())
            at += 1
    return b"".join(out)


RESULT = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


@tidied
def _encode_batches(
    batches: Iterator[pa.RecordBatch], path: str, column: str, keep: list[str], with_ids: bool
) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(path)
    for batch in batches:
        at = batch.schema.get_field_index(column)
        for start in range(0, len(batch), 512):
            part = batch.slice(start, 512)
            counts, packed, digests, decoded = [], [], [], []
            for text in part.column(at):
                ids = encoder.encode(text.as_py() or "")
                raw = ids.tobytes()
                counts.append(len(ids))
                packed.append(raw if with_ids else None)
                digests.append(hashlib.sha256(raw).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode_bytes(ids)).hexdigest())
            columns = [part.column(part.schema.get_field_index(c)) for c in keep]
            columns += [pa.array(counts, pa.int64())]
            columns += [pa.array(packed, pa.binary())] if with_ids else []
            columns += [pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            names = [*keep, "n_tokens", *(["ids"] if with_ids else []), "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays(columns, names)


def encode_documents(docs: DataFrame, path: str, text: str = "text", with_ids: bool = True) -> DataFrame:
    """Add n_tokens, ids (little-endian unsigned 32-bit numbers) and the digests of ids and decoded text to every row.

    ``path`` is the model file on every executor. A null text is encoded as the empty one: begin and end ids only. Texts of any
    length are encoded whole. Existing columns of the added names are replaced; an empty table gives an empty result.
    """
    added = [f for f in RESULT.fields if with_ids or f.name != "ids"]
    keep = [c for c in docs.columns if c not in RESULT.names]
    columns = list(dict.fromkeys([*keep, text]))
    schema = T.StructType([docs.schema[c] for c in keep] + added)
    run = partial(_encode_batches, path=path, column=text, keep=keep, with_ids=with_ids)
    return docs.select(*columns).mapInArrow(run, schema)
