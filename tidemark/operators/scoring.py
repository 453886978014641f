"""Apply a caller's text model to a prompt column."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import reply_text

Model = Callable[[str], str | None]
BatchModel = Callable[[list[str]], list[str | None]]

ATTEMPTS = 2
_SCORED = "__scored"


def one_by_one(model: Model) -> BatchModel:
    """A model of single texts as one of lists; a text that raises has no reply."""

    def ask(prompts: list[str]) -> list[str | None]:
        replies = []
        for prompt in prompts:
            try:
                replies.append(model(prompt))
            except Exception:  # the model is outside code; the row's status tells of the failure
                replies.append(None)
        return replies

    return ask


def score_prompts(
    df: DataFrame,
    prompt: str,
    output: str,
    fallback: Column,
    model: Model | None = None,
    attempts: int = ATTEMPTS,
    batch_model: BatchModel | None = None,
    status: str | None = None,
) -> DataFrame:
    """Add ``output``: the model's answer to ``prompt``, or ``fallback``.

    Only the prompt goes through Python, an Arrow batch at a time. Prompts
    whose reply holds no text are asked again, ``attempts`` times in all;
    ``batch_model`` takes and gives a list, ``model`` one text. ``status`` names
    a column that tells ``answered``, ``failed`` or ``no model``. Without a model
    no Python worker starts.
    """
    ask = batch_model or (one_by_one(model) if model else None)
    if ask is None:
        plain = df.withColumn(output, fallback)
        return plain.withColumn(status, F.lit("no model")) if status else plain

    @F.pandas_udf("string")
    def replies(prompts: pd.Series) -> pd.Series:
        found = pd.Series([None] * len(prompts), index=prompts.index, dtype=object)
        open_ = list(prompts.index)
        for _ in range(attempts):
            if not open_:
                break
            try:
                given = ask([prompts[i] for i in open_])
            except Exception:  # a batch that raises has no reply and is asked again
                continue
            for i, reply in zip(open_, given, strict=True):
                found[i] = reply if reply and reply.strip() else None
            open_ = [i for i in open_ if found[i] is None]
        return found

    answer = F.nullif(reply_text(F.col(_SCORED)), F.lit(""))
    # Models need not answer alike twice, so the optimizer must not call them twice.
    scored = df.withColumn(_SCORED, replies.asNondeterministic()(F.col(prompt)))
    out = scored.withColumn(output, F.coalesce(answer, fallback))
    if status:
        out = out.withColumn(status, F.when(answer.isNotNull(), "answered").otherwise("failed"))
    return out.drop(_SCORED)
