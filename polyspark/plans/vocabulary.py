"""Learn a vocabulary on a corpus and append it to an old one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from polyspark.operators.vocab import extend_vocab, learn_vocabulary, tokenizer_compare, vocab_report


def extend_from_corpus(
    corpus: DataFrame, old: DataFrame, vocab_size: int, by: list[str], coverage: float = 1.0
) -> dict[str, DataFrame]:
    """The learnt and the merged vocabulary, their sizes, and token counts under old and merged."""
    new = learn_vocabulary(corpus, vocab_size, coverage)
    merged = extend_vocab(old, new)
    return {
        "new": new,
        "merged": merged,
        "report": vocab_report(old, new, merged),
        "comparison": tokenizer_compare(corpus, {"old": old, "merged": merged}, by),
    }
