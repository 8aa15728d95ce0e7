"""Classification of entries without a part of speech: choice, batches, prompts, an injected model, notes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.display import json_in_text, prompt_line, suggestion
from .nested import flatten_senses
from .ranking import ranked

#: Rows of a batch, and what marks a note as a suggestion.
BATCH, MARK = 20, "AI suggests:"


def missing_speech(entries: DataFrame) -> DataFrame:
    return entries.where("nullif(g.ps, '') is null")


def unannotated(entries: DataFrame, annotations: DataFrame) -> DataFrame:
    """Entries without a part of speech that no suggestion was noted for. Entries without an id stay."""
    noted = annotations.where((F.col("type") == "needs-review") & F.col("note").startswith(MARK)).select(F.col("rid").alias("id"))
    return missing_speech(entries).join(noted, "id", "left_anti")


def drop_notes(annotations: DataFrame, note: str) -> DataFrame:
    """The annotations without those of one note; a null note is another note."""
    return annotations.where(~F.col("note").eqNullSafe(note))


def first_definition(entries: DataFrame, key: str = "seq") -> DataFrame:
    """Entries with ``definition``, that of the first sense; '' where there is none."""
    first = flatten_senses(entries, "c", key, text=True).where("kind = 'sense' and path = '0'").select(key, F.col("d").alias("definition"))
    return entries.join(first, key, "left").withColumn("definition", F.coalesce("definition", F.lit("")))


def batches(entries: DataFrame, size: int = BATCH) -> DataFrame:
    """``batch, n, prompt``: entries with a ``definition`` chunked in file order, one line each. A batch is at most ``size``
    rows."""
    lines = entries.select("seq", prompt_line(F.col("id"), F.col("hw"), F.col("g.l"), F.col("definition")).alias("line"))
    numbered = ranked(lines, [], [F.col("seq")]).withColumn("batch", F.floor((F.col("rank") - 1) / size))
    return numbered.groupBy("batch").agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "line"))), lambda x: x.line), "\n").alias("prompt"))


def classify(prompts: DataFrame, model: Callable[[str], str]) -> DataFrame:
    """``batch, answer``: the model's text for each prompt. The model is called in the tasks; an exception gives a null answer."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = []
            for prompt in frame.prompt:
                try:
                    answers.append(model(prompt))
                except Exception:  # noqa: BLE001 - a failed batch is reported as null and may be asked again
                    answers.append(None)
            yield pd.DataFrame({"batch": frame.batch, "answer": answers})

    return prompts.select("batch", "prompt").mapInPandas(run, "batch long, answer string")


def suggestions(answers: DataFrame, created: str) -> DataFrame:
    """Annotations from answers: ``rid, type, note, created``; answers without a JSON array give none."""
    items = F.from_json(F.nullif(json_in_text(F.col("answer")), F.lit("")), "array<struct<rid:string,ps:string,gn:string>>")
    each = answers.select(F.explode(items).alias("x")).where("x.rid is not null and x.ps is not null")
    return each.select(F.col("x.rid").alias("rid"), F.lit("needs-review").alias("type"), suggestion(F.col("x.ps"), F.col("x.gn")).alias("note"), F.lit(created).cast("date").alias("created"))


def edges_of_bursts(events: DataFrame, key: str, at: str, gap_ms: int = 150) -> DataFrame:
    """Debounce: the events of a key after which at least ``gap_ms`` pass without another."""
    after = F.lead(at).over(Window.partitionBy(key).orderBy(at, "event_id"))
    return events.withColumn("__next", after).where(F.col("__next").isNull() | (F.col("__next") - F.col(at) >= F.expr(f"interval {gap_ms} milliseconds"))).drop("__next")
