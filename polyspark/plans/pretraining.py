"""Raw text to fixed-size blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame

from polyspark.operators.corpus import block_size_for, pack_blocks
from polyspark.operators.tokens import tokenize
from polyspark.sources.sinks import materialize, stage_key


def prepare_corpus(
    corpus: DataFrame,
    vocab: DataFrame,
    out: str,
    model: str,
    data: str,
    block_size: int | None,
    model_max: int,
    id_col: str = "doc_id",
    by: list[str] | None = None,
    overwrite: bool = False,
) -> dict[str, DataFrame]:
    """Tokens and blocks, each written once and read back on the next run."""
    by = by or []
    size = block_size_for(block_size, model_max)
    n_vocab = vocab.count()
    tokens = tokenize(corpus, vocab, keys=[*by, id_col])
    tokens = materialize(tokens, f"{out}/{stage_key(model, data, n_vocab)}", overwrite)
    blocks = pack_blocks(tokens, id_col, size, by=by)
    blocks = materialize(blocks, f"{out}/{stage_key(model, data, n_vocab, size)}", overwrite)
    return {"tokens": tokens, "blocks": blocks}
