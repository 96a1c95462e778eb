"""A registry of named questions: ``name -> (title, fn(DataFrame) -> DataFrame)``.

Every answer is a DataFrame (a scalar is one row and one column) that the
caller can show, write or join. Questions whose plan depends on fitted facts
(exact n-tile boundaries, checkpointed group tables) compute those small
facts when called; the answer's own rows are computed when the caller acts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

Answer = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Question:
    name: str
    title: str
    fn: Answer


class QuestionRegistry:
    def __init__(self) -> None:
        self._items: dict[str, Question] = {}

    def register(self, name: str, title: str) -> Callable[[Answer], Answer]:
        def deco(fn: Answer) -> Answer:
            if name in self._items:
                raise ValueError(f"question {name!r} already registered")
            self._items[name] = Question(name, title, fn)
            return fn
        return deco

    def names(self) -> list[str]:
        return list(self._items)

    def get(self, name: str) -> Question:
        return self._items[name]

    def answer(self, name: str, df: DataFrame) -> DataFrame:
        return self._items[name].fn(df)

    def run(self, df: DataFrame, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """Answers of the named questions (all of them by default), in order."""
        return {n: self.answer(n, df) for n in (names or self.names())}


def write_answers(answers: dict[str, DataFrame], root: str, fmt: str = "parquet") -> list[str]:
    """Write each answer as a table under ``root/<name>``; returns the paths."""
    from ..sources.files import write_table
    paths = []
    for name, df in answers.items():
        path = f"{root.rstrip('/')}/{name}"
        write_table(df, path, fmt=fmt)
        paths.append(path)
    return paths
