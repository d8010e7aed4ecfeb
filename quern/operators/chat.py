"""Chat rows from prompts, answers and episodes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.keys import is_blank


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def thinking(reasoning: Column, response: Column) -> Column:
    """Answer with its usable reasoning before it."""
    return F.when(reasoning.isNotNull(), F.concat(F.lit("<think>\n"), reasoning, F.lit("\n</think>\n\n"), response)).otherwise(response)


def messages(prompt: Column, response: Column, system: Column | None = None, turns: Column | None = None) -> Column:
    """Messages of a row: system if present, then the filled user and assistant turns of an episode, else prompt and answer."""
    head = F.array() if system is None else F.array_compact(F.array(F.when(~is_blank(system), turn("system", system))))
    plain = F.array(turn("user", prompt), turn("assistant", response))
    if turns is None:
        return F.concat(head, plain) if system is not None else plain
    usable = F.filter(turns, lambda t: t.role.isin("user", "assistant") & ~is_blank(t.content))
    usable = F.transform(usable, lambda t: F.struct(t.role.alias("role"), t.content.alias("content")))
    body = F.when(F.size(usable) > 0, usable).otherwise(plain)
    return F.concat(head, body) if system is not None else body


def chat_rows(rows: DataFrame, key: str, column: Column) -> DataFrame:
    """One row per message: ``key, position, role, content``."""
    return rows.select(key, F.posexplode(column).alias("position", "m")).select(key, "position", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


def assistant_turns(turns: Column) -> Column:
    """Number of assistant turns; 0 for null."""
    return F.coalesce(F.size(F.filter(turns, lambda t: t.role == "assistant")), F.lit(0))
