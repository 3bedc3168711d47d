"""Token counts with overlap resynchronisation for huge documents (operator 3).

Texts up to ``huge_bytes`` are encoded whole. A longer text is encoded in chunks that overlap.
Two neighbouring chunks are spliced at a boundary that both encodings have inside their overlap
and that is proven stable; where there is none the overlap is widened, in the end over the
whole text.

A boundary is proven stable if no piece of the vocabulary can span it, whatever stands around:
before a space that follows a character that is no space (no piece has a space after another
character), or on either side of a line feed (no piece holds one). Both are checked against
the loaded vocabulary; a model for which neither holds has its texts encoded whole.

Edge cases: a null or empty text has 0 bytes and 0 tokens; strings of special tokens inside a text are
ordinary text, as the library treats them; each row of a repeated document is counted; other columns pass through, but
for n_bytes, n_tokens and over_limit, which the results replace.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, schema_of, ship, slices, table, with_plain_names, without

LIMIT = 4096
HUGE_BYTES, CHUNK_BYTES, OVERLAP_BYTES = 1 << 16, 1 << 15, 1 << 9
MODEL = "piece_bpe_32k.model"
SPACE = "▁"


class PieceEncoder:
    """The library's processor, with the boundaries that its vocabulary proves stable."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.processor.id_to_piece(i) for i in range(self.processor.get_piece_size())]
        spaces = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        feeds = not any("\n" in p for p in pieces)
        plain = self.processor.normalize(" a  b\nc ") in (" a  b\nc ", f"{SPACE}a{SPACE}{SPACE}b\nc{SPACE}", f"{SPACE}{SPACE}a{SPACE}{SPACE}b\nc{SPACE}")
        parts = ([rb"(?<=[^ \n])(?<!\xe2\x96\x81)(?= )"] if spaces else []) + ([rb"(?<=\n)", rb"(?=\n)"] if feeds else [])
        self.stable = re.compile(b"|".join(parts)) if plain and parts else None

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.processor.encode(texts, num_threads=1)]

    def starts(self, text: bytes) -> np.ndarray:
        """Byte offsets at which the tokens of the text begin."""
        pieces = self.processor.encode(text.decode("utf-8", "replace"), return_type="proto").pieces
        return np.fromiter((p.begin for p in pieces), np.int64, len(pieces))


def char_start(text: bytes, at: int) -> int:
    """The first character boundary at or after ``at``."""
    while at < len(text) and text[at] & 0xC0 == 0x80:
        at += 1
    return min(at, len(text))


def splice_count(
    text: bytes, starts: Callable[[bytes], np.ndarray], stable: re.Pattern | None, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES
) -> int:
    """Tokens of the whole text, from encodings of overlapping chunks."""
    total, begin = 0, 0
    low = 0  # tokens of this chunk count from here on, as a proven boundary of the whole text
    while True:
        end = char_start(text, begin + chunk)
        width = overlap
        while True:
            stop = char_start(text, end + width)
            if stop >= len(text) or stable is None:
                at = starts(text[begin:]) + begin
                return total + int((at >= low).sum())
            here = starts(text[begin:stop]) + begin
            after = starts(text[end:stop]) + end
            # Neither chunk's edge is a boundary of the whole text.
            common = np.intersect1d(here, after)
            proven = {m.start() for m in stable.finditer(text, end + 1, stop)}
            shared = [int(x) for x in common if end < x < stop and int(x) in proven and int(x) > low]
            if shared:
                break
            width *= 2
        cut = shared[0]
        total += int(((here >= low) & (here < cut)).sum())
        begin, low = end, cut


def _encoder(path: str, cache: dict = {}) -> PieceEncoder:  # noqa: B006  one for each worker
    if path not in cache:
        cache[path] = PieceEncoder(path)
    return cache[path]


@with_plain_names
def count_tokens(
    docs: DataFrame, model: str, limit: int = LIMIT, huge_bytes: int = HUGE_BYTES, chunk: int = CHUNK_BYTES, overlap: int = OVERLAP_BYTES
) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (more than ``limit`` tokens) in place of text."""
    ship(docs.sparkSession)
    docs = without(docs, "n_bytes", "n_tokens", "over_limit")
    names = [x for x in docs.columns if x != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in slices(batches, most=1 << 20):
            texts = as_bytes(batch.column("text"))
            counts = np.zeros(len(texts), np.int64)
            plain = [i for i, t in enumerate(texts) if len(t) <= huge_bytes]
            counts[plain] = encoder.count([texts[i].decode("utf-8", "replace") for i in plain])
            for i, t in enumerate(texts):
                if len(t) > huge_bytes:
                    counts[i] = splice_count(t, encoder.starts, encoder.stable, chunk, overlap)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in names), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts), pa.array(counts > limit)],
                names=[*names, "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.mapInArrow(run, schema_of(docs, "n_bytes long, n_tokens long, over_limit boolean", "text"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path(MODEL)).select("doc_id", F.col("n_bytes"), "n_tokens", "over_limit")
