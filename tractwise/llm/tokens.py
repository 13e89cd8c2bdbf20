"""Token ids of whole texts by a byte-level vocabulary."""

from __future__ import annotations

import functools
import json
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of the texts that are encoded at once, unless one text has more.
SLICE = 4 * 1024 * 1024
#: A run of white space, or of other characters without a break, beyond which the plain encoder takes a text.
RUN = 50_000


def _byte_of() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary's tokens stands for."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Ids of texts by the vocabulary of a byte-level BPE file.

    The ids are those of the ``tokenizers`` library. Where the vocabulary's ids are its
    merge ranks and it splits by the usual pattern, texts are encoded by ``tiktoken``,
    which takes a fraction of the time; texts that hold a special token's name or a run
    of ``RUN`` characters without a break, and all texts of other vocabularies, are
    encoded by ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.special = sorted(special)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        vocabulary, split = made["model"]["vocab"], made.get("pre_tokenizer") or {}
        byte = _byte_of()
        self.fast = None
        plain = {t: i for t, i in vocabulary.items() if t not in special}
        ranked = [m if isinstance(m, str) else " ".join(m) for m in made["model"].get("merges", ())]
        merged = [plain.get(m.replace(" ", ""), -1) for m in ranked]
        if (split.get("type") == "ByteLevel" and not split.get("add_prefix_space") and made.get("normalizer") is None
                and merged == sorted(set(merged)) and all(c in byte for t in plain for c in t)):
            ranks = {bytes(byte[c] for c in t): i for t, i in plain.items()}
            self.fast = tiktoken.Encoding(
                "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _plain(self, texts: pa.Array) -> np.ndarray:
        """Which texts only the plain encoder may take."""
        if self.fast is None:
            return np.ones(len(texts), bool)
        plain = np.zeros(len(texts), bool)
        for name in self.special:
            plain |= pc.match_substring(texts, name).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False) >= RUN):
            text = texts[i].as_py()
            cuts = np.flatnonzero(np.diff(np.fromiter(map(str.isspace, text), bool, len(text)), prepend=2, append=2))
            plain[i] |= bool(np.diff(cuts).max(initial=0) >= RUN)
        return plain

    def __call__(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (NULL is empty), each closed by ``end``, and where each text begins; one more at the end."""
        texts = texts.cast(pa.large_string()).fill_null("")
        plain = self._plain(texts)
        slow = iter(self.whole(texts.filter(pa.array(plain)).to_pylist()))
        close = np.array([end], np.uint32)
        parts = []
        for text, slowly in zip(texts.to_pylist(), plain):
            ids = next(slow) if slowly else self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
            parts += [ids, close]
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))[1::2]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.concatenate([[0], ends]).astype(np.int64)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once per worker."""
    return Vocabulary(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE):
    """``batch`` in parts of at most ``limit`` bytes of text, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    sizes = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < batch.num_rows:
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def checksum(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit numbers."""
    return zlib.crc32(np.ascontiguousarray(ids, "<u4"))
