"""Subword ids of whole texts.

Byte-level BPE: the vocabulary is ranked by its merges, so a second encoder of the same vocabulary gives the same ids on
characters that both put in the same class; any other text goes to the tokenizers library. SentencePiece BPE never joins
characters across certain places before a space: a text is cut there and distinct chunks are remembered, in bounded
memory. Nothing is cut short.
"""

from __future__ import annotations

import functools
import json
import os
import re
import sys
from array import array

import numpy as np

SPACE = "▁"
REMEMBERED_BYTES = 20 << 20
ENTRY_BYTES = 180


class _Memo(dict):
    """Chunk to value. Chunks that are not there are encoded together; a memo over its bytes starts anew."""

    def __init__(self, encode_all, most_bytes: int = REMEMBERED_BYTES) -> None:
        super().__init__()
        self.encode_all, self.most_bytes, self.held = encode_all, most_bytes, 0

    def joined(self, texts: list[list[str]]) -> list[bytes]:
        """The values of each text's chunks, strung together."""
        missing = list({word: None for words in texts for word in words if word not in self})
        values = self.encode_all(missing)
        self.update(zip(missing, values))
        self.held += sum(map(len, missing)) + sum(map(len, values)) + ENTRY_BYTES * len(missing)
        found = [b"".join(map(self.__getitem__, words)) for words in texts]
        if self.held > self.most_bytes:
            self.clear()
            self.held = 0
        return found


def byte_of_letter() -> dict[str, int]:
    """Byte-level BPE writes a byte that prints as itself, and the others in order from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """The tokenizers library's byte-level BPE, as it stands in ``path``; add_special_tokens is off.

    With ``plain`` the strings of special tokens are ordinary text. Texts of Latin, Greek, Cyrillic, Han, kana and Hangul
    characters and common marks are encoded by the faster library, all others by the tokenizers library; the tests hold
    both against each other on every such character.
    """

    #: Characters that both libraries put in the same class; a test goes through all of them.
    OTHER = re.compile("[^\x00-\u024f\u0370-\u0377\u037a-\u037f\u0384-\u052f\u2000-\u206f\u20a0-\u20bf\u3040-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]")
    #: The faster library looks back over a run of white space.
    LONG_SPACE = re.compile(r"\s{256}")
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str, plain: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        size = self.library.get_vocab_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if size <= 1 << 16 else "I"
        with open(path) as f:
            spec = json.load(f)
        letters = byte_of_letter()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = [] if plain else list(added)
        self.bytes_of = [b""] * size
        for token, number in spec["model"]["vocab"].items():
            if token not in added:
                self.bytes_of[number] = bytes(letters[c] for c in token)
        self.fast = self._ranked(spec, added)

    def _ranked(self, spec: dict, added: dict[str, int]):
        """The faster encoder, or None where ids do not follow the order of the merges or the text is prepared otherwise."""
        vocab, step = spec["model"]["vocab"], spec["pre_tokenizer"] or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        in_order = all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        plain = step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space")
        odd = any(spec["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        if not in_order or not plain or odd or spec["normalizer"] or sys.byteorder != "little":
            return None
        import tiktoken

        ranks = {self.bytes_of[i]: i for t, i in vocab.items() if t not in added}
        return tiktoken.Encoding("ranked", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts: list[str]) -> list[bytes]:
        done = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() for x in done]

    def common(self, text: str) -> bool:
        """Whether both libraries are known to agree on ``text``."""
        return not (
            self.fast is None
            or self.OTHER.search(text)
            or self.LONG_SPACE.search(text)
            or any(t in text for t in self.special)
        )

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as packed integers of ``kind``."""
        return [
            array(self.code, self.fast.encode_ordinary(t)).tobytes() if self.common(t) else self.whole([t])[0] for t in texts
        ]


class Normaliser:
    """SentencePiece's text normalisation with the source of every byte.

    The compiled character map is a double-array trie over UTF-8 prefixes; the longest prefix that it holds is replaced
    by its string, any other character stands for itself.
    """

    def __init__(self, spec) -> None:
        self.spec = spec
        blob = spec.precompiled_charsmap
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.trie = np.frombuffer(blob[4 : 4 + size], "<u4").tolist()
        self.strings = blob[4 + size :]

    def prefix(self, data: bytes, at: int) -> tuple[bytes, int]:
        """What stands for the longest known prefix of ``data[at:]``, and that prefix's length."""
        found, length, node = None, 0, 0
        if self.trie:
            unit = self.trie[0]
            node = (unit >> 10) << ((unit & 512) >> 6)
            for i in range(at, len(data)):
                node ^= data[i]
                if node >= len(self.trie) or (unit := self.trie[node]) & 0x800000FF != data[i]:
                    break
                node ^= (unit >> 10) << ((unit & 512) >> 6)
                if unit >> 8 & 1:
                    found, length = self.trie[node] & 0x7FFFFFFF, i + 1 - at
        if found is not None:
            return self.strings[found : self.strings.index(0, found)], length
        lead = data[at]
        length = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return data[at : at + length], length

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and the end) the offset of its source in the text's bytes."""
        data = text.encode()
        if not data:
            return "", np.zeros(1, np.int64)
        mark = SPACE.encode() if self.spec.escape_whitespaces else b" "
        if not self.trie and not self.spec.remove_extra_whitespaces:
            source = np.arange(len(data) + 1)
            if len(mark) > 1 and 32 in data:
                copies = np.ones(len(data) + 1, np.int64)
                copies[np.flatnonzero(np.frombuffer(data, np.uint8) == 32)] = len(mark)
                source = np.repeat(source, copies)
            out = text.replace(" ", mark.decode())
            if self.spec.add_dummy_prefix:
                out, source = mark.decode() + out, np.concatenate([np.zeros(len(mark), np.int64), source])
            return out, source
        squeeze = self.spec.remove_extra_whitespaces
        out, source, at = bytearray(), [], 0
        while squeeze and at < len(data):
            new, length = self.prefix(data, at)
            if new != b" ":
                break
            at += length
        if at == len(data):
            return "", np.zeros(1, np.int64)
        if self.spec.add_dummy_prefix:
            out += mark
            source += [at] * len(mark)
        after_space = squeeze
        while at < len(data):
            new, length = self.prefix(data, at)
            if after_space:
                new = new.lstrip(b" ")
            if new:
                for byte in new:
                    own = mark if byte == 32 else bytes([byte])
                    out += own
                    source += [at] * len(own)
                after_space = squeeze and new.endswith(b" ")
            at += length
        while squeeze and out.endswith(mark):
            del out[-len(mark) :]
            at = source[len(out)]
            del source[len(out) :]
        return out.decode(errors="replace"), np.array([*source, at], np.int64)


class Pieces:
    """SentencePiece ids of a text, with the source bytes of every piece.

    Normalisation is this module's own; the library, loaded without a normaliser, finds the pieces of normalised chunks.
    """

    CHUNK = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def __init__(self, path: str) -> None:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as f:
            model = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normaliser = Normaliser(type(model.normalizer_spec).FromString(model.normalizer_spec.SerializeToString()))
        spec = model.normalizer_spec
        spec.precompiled_charsmap, spec.name = b"", "identity"
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.plain = sentencepiece.SentencePieceProcessor()
        self.plain.LoadFromSerializedProto(model.SerializeToString())
        # A piece with a space mark after another character could cross a cut.
        self.cuts = model.trainer_spec.model_type == 2 and not any(
            SPACE in p.piece.lstrip(SPACE) for p in model.pieces if p.type in (1, 4)
        )
        self.n_bytes = np.array([1 if p.type == 6 else len(p.piece.encode()) for p in model.pieces])
        self.decimal = [str(i) for i in range(len(model.pieces))]
        self.bytes_of = [
            bytes([int(p.piece[3:5], 16)]) if p.type == 6 else p.piece.replace(SPACE, " ").encode() for p in model.pieces
        ]
        self.unknown = model.trainer_spec.unk_id if not model.trainer_spec.byte_fallback else -1
        self.memo = _Memo(lambda words: self.whole([SPACE + w for w in words]))

    def whole(self, chunks: list[str]) -> list[bytes]:
        """Of each normalised text pairs of id and byte length, packed."""
        done = []
        for chunk, ids in zip(chunks, self.plain.encode(chunks, num_threads=1)):
            sizes = self.n_bytes[ids]
            if self.unknown in ids:
                sizes = [len(p.surface.encode()) for p in self.plain.encode(chunk, return_type="proto").pieces]
            pairs = np.empty((len(ids), 2), "<u4")
            pairs[:, 0], pairs[:, 1] = ids, sizes
            done.append(pairs.tobytes())
        return done

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text the ids, and where each piece begins and ends in the text's bytes."""
        normal = [self.normaliser(t) for t in texts]
        cut = [self._chunks(t) for t, _ in normal]
        first = self.whole([x[0] for x in cut])
        done = []
        for a, b, (_, source) in zip(first, self.memo.joined([x[1:] for x in cut]), normal):
            pairs = np.frombuffer(a + b, "<u4").reshape(-1, 2)
            edges = np.zeros(len(pairs) + 1, np.int64)
            np.cumsum(pairs[:, 1], out=edges[1:])
            edges = source[edges]
            done.append((pairs[:, 0], edges[:-1], edges[1:]))
        return done

    def _chunks(self, normal: str) -> list[str]:
        """What stands before the first space mark, then each mark's chunk without the mark."""
        if not self.cuts:
            return [normal]
        if SPACE * 2 not in normal:
            return normal.split(SPACE)
        head = normal[: normal.index(SPACE)]
        return [head, *[x[1:] for x in self.CHUNK.findall(normal[len(head) :])]]

    def joined(self, ids: list[int]) -> str:
        """The ids in decimal, joined by commas."""
        return ",".join(map(self.decimal.__getitem__, ids))


@functools.lru_cache
def byte_bpe(path: str, plain: bool = False) -> ByteBpe:
    """One encoder per worker, so that it is loaded once."""
    return ByteBpe(path, plain)


@functools.lru_cache
def pieces_of(path: str) -> Pieces:
    return Pieces(path)
