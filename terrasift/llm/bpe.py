"""BPE encoding of long texts by tree concatenation, and decoding.

A long text is cut in halves down to leaves, which are encoded independently.
Two encoded halves are joined by encoding a window of text around the cut anew.
The window grows until, on both sides of the cut, two adjacent tokens of the
window agree exactly (place and id) with two adjacent tokens of the half. From
such a place on both sequences go on alike, so the half's tokens stand before
the left place and after the right one, and the window's between.

Texts that no blank splits are joined the same way, inside one long word: a
sequence is the encoding of its text when every adjacent pair of tokens is, and
at both places the pair is one that the half already had.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.llm.common import small_batches

LEAF_BYTES = 4096
# Fixed value: how byte-level tokenizers split text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_WINDOW = 96  # bytes on each side of a cut, doubled until both sides agree
_MARGIN = 32  # bytes next to a cut or a window's end that prove nothing
_BATCH_CHARS = 1 << 21


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class TreeEncoder:
    """Encodes as the given byte-level tokenizer does, long texts in pieces."""

    def __init__(self, vocabulary: str, leaf: int = LEAF_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leaf = leaf
        special = {i: t.content for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # Byte-level tokens are spelt with one character for each byte.
        self.length = np.array(
            [len(special[i].encode()) if i in special else len(self.tokenizer.id_to_token(i) or "") for i in range(size)], dtype=np.int64
        )
        self.spelt = [str(i) for i in range(size)]
        self.fast = self._merger(vocabulary, special)

    def _merger(self, vocabulary: str, special: dict[int, str]):
        """A faster encoder for the usual kind of file: plain byte-level BPE whose ids follow the order of its merges."""
        import tiktoken

        with open(vocabulary, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
            and not spec.get("normalizer") and not spec.get("post_processor") and model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and not any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])
        )
        # Printable bytes stand for themselves, the others follow from 256 on.
        own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        spelling = {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        ids = [model["vocab"].get(a + b, -1) for a, b in pairs]
        if not plain or ids != sorted(set(ids)) or min(ids, default=-1) < 256 or len(model["vocab"]) != 256 + len(ids):
            return None
        ranks = {bytes(spelling[c] for c in token): i for token, i in model["vocab"].items() if i not in special}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={t: i for i, t in special.items()})

    def _encode(self, pieces: list[str]) -> list[np.ndarray]:
        if self.fast:
            return [self.fast.encode_to_numpy(p, allowed_special="all").astype(np.int64) for p in pieces]
        found = self.tokenizer.encode_batch(pieces, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.int64) for e in found]

    def _pieces(self, text: str) -> list[bytes]:
        data = text.encode("utf-8")
        if len(data) <= self.leaf:
            return [data]

        def halves(lo: int, hi: int) -> list[bytes]:
            if hi - lo <= self.leaf:
                return [data[lo:hi]]
            cut = (lo + hi) // 2
            while data[cut] & 0xC0 == 0x80:  # never inside a character
                cut += 1
            return halves(lo, cut) + halves(cut, hi)

        return halves(0, len(data))

    def _agreed(self, at_a, a, at_b, b, lo: int, hi: int) -> tuple[int, int] | None:
        """Indexes in a and b of a token that starts at one place in (lo, hi), where it and the one before it agree."""
        _, i, j = np.intersect1d(at_a, at_b, assume_unique=False, return_indices=True)
        ok = (i > 0) & (j > 0) & (at_a[i] >= lo) & (at_a[i] <= hi) & (self.length[a[i]] > 0)
        i, j = i[ok], j[ok]
        ok = (a[i] == b[j]) & (a[i - 1] == b[j - 1])
        return (int(i[ok][0]), int(j[ok][0])) if ok.any() else None

    def _join(self, left: bytes, a: np.ndarray, right: bytes, b: np.ndarray) -> np.ndarray:
        """Tokens of left + right from those of both."""
        cut, end = len(left), len(left) + len(right)
        at_a = np.cumsum(self.length[a]) - self.length[a]
        at_b = np.cumsum(self.length[b]) - self.length[b] + cut
        window = _WINDOW
        while True:
            lo, hi = max(0, cut - window), min(end, cut + window)
            # The window starts with a token of the left half, at a character.
            k = max(0, int(np.searchsorted(at_a, lo, "right")) - 1)
            while k > 0 and left[at_a[k]] & 0xC0 == 0x80:
                k -= 1
            start = int(at_a[k]) if len(at_a) else 0
            while hi < end and right[hi - cut] & 0xC0 == 0x80:
                hi += 1
            m = self._encode([(left[start:] + right[: hi - cut]).decode("utf-8")])[0]
            at_m = np.cumsum(self.length[m]) - self.length[m] + start
            before = (k, 0) if start == 0 else self._agreed(at_a, a, at_m, m, start + 1, cut - _MARGIN)
            after = (len(m), len(b)) if hi == end else self._agreed(at_m, m, at_b, b, cut + _MARGIN, hi - _MARGIN)
            if before and after and before[1] <= after[0]:
                return np.concatenate([a[: before[0]], m[before[1] : after[0]], b[after[1] :]])
            window *= 2

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token ids of each text."""
        pieces = [self._pieces(t) for t in texts]
        ids = iter(self._encode([p.decode("utf-8") for ps in pieces for p in ps]))
        result = []
        for ps in pieces:
            level = [(p, next(ids)) for p in ps]
            while len(level) > 1:
                level = [
                    (level[i][0] + level[i + 1][0], self._join(*level[i], *level[i + 1])) if i + 1 < len(level) else level[i]
                    for i in range(0, len(level), 2)
                ]
            result.append(level[0][1])
        return result

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        if self.fast:
            return [self.fast.decode_bytes(x.tolist()).decode("utf-8", "replace") for x in ids]
        return self.tokenizer.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)


def encode_documents(docs: DataFrame, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_tokens, ids_sha256, decoded_sha256
    and, with ``keep_ids``, ids (array of int) and decoded.

    Null texts count as empty and have no tokens. Rows without a doc_id and
    repeated rows stay as they are; other columns are not read. ``vocabulary`` is
    a tokenizer file that every worker can read.
    """
    small_batches(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    fields = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep_ids else "")

    def run(batches):
        from hashlib import sha256

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        encoder = TreeEncoder(vocabulary)
        spelt = encoder.spelt
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            out: list[list] = [[], [], [], [], []]
            at = 0
            while at < len(texts):
                upto, room = at, _BATCH_CHARS
                while upto < len(texts) and (upto == at or room >= len(texts[upto])):
                    room -= len(texts[upto])
                    upto += 1
                ids = encoder.encode(texts[at:upto])
                decoded = encoder.decode(ids)
                out[0] += [len(x) for x in ids]
                out[1] += [sha256(",".join([spelt[i] for i in x.tolist()]).encode()).hexdigest() for x in ids]
                out[2] += [sha256(d.encode("utf-8")).hexdigest() for d in decoded]
                if keep_ids:
                    out[3] += [x.astype(np.int32) for x in ids]
                    out[4] += decoded
                at = upto
            columns = [batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns += [pa.array(out[3], pa.list_(pa.int32())), pa.array(out[4], pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, fields)
