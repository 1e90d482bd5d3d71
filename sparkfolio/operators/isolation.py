"""Batch functions over rows of which some fail."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from sparkfolio.storage import materialise

Call = Callable[[pd.DataFrame], pd.DataFrame]
MOST_ERROR = 500  # characters kept


def waits(most: float = 10.0) -> Callable[[int], float]:
    """Seconds before a try: 1, 2, 4, ..., at most ``most``."""
    return lambda tried: min(most, 2.0 ** (tried - 1))


def call_apart(call: Call, frame: pd.DataFrame, tries: int = 1, again: tuple[type[Exception], ...] = (), wait: Callable[[int], float] = lambda tried: 0.0) -> Iterator[tuple[pd.DataFrame, str | None]]:
    """(result, None) of each part of ``frame`` that ``call`` takes, (row, error) of each row that it doesn't.

    A part that raises is halved until the bad row stands alone: a bad row in
    n costs some 2 log2(n) calls more, and the others still go together. A
    lone row that raises one of ``again`` is tried up to ``tries`` times.
    """
    parts = [frame]
    while parts:
        part = parts.pop()
        for tried in range(1, tries + 1):
            try:
                yield call(part.copy()), None
            except Exception as e:  # noqa: BLE001 - whatever a row makes the function raise
                if len(part) > 1:
                    half = len(part) // 2
                    parts += [part.iloc[half:], part.iloc[:half]]
                elif tried < tries and isinstance(e, again):
                    time.sleep(wait(tried))
                    continue
                else:
                    yield part, f"{type(e).__name__}: {e}"[:MOST_ERROR]
            break


def isolate(
    rows: DataFrame,
    call: Call,
    schema: str,
    keys: list[str],
    batch_rows: int = 256,
    tries: int = 1,
    again: tuple[type[Exception], ...] = (),
    wait: Callable[[int], float] = lambda tried: 0.0,
) -> tuple[DataFrame, DataFrame]:
    """(results, errors) of a batch function over all rows; a row that makes it raise never costs another its result.

    ``call`` takes a pandas frame of up to ``batch_rows`` rows and returns one
    with the columns of ``schema``, any number of rows. Results have that
    schema; errors are the key columns and ``error`` (type and message, 500
    characters at most). Both are read from one written table, so a row's
    result and error can't both be missing or both be there, and the function
    isn't run again by those who read them; but rows beside a bad one, and all
    rows of a lost task, may be given to it several times. Results with other
    columns than ``schema`` end the job: that is no row's fault. Null keys are
    kept; repeated rows each count. Empty input: two empty relations.
    """
    out = StructType.fromDDL(schema)
    result, names = out.names, [f"_key{i}" for i in range(len(keys))]
    if clash := {*names, "_error"} & {*result}:
        raise ValueError(f"names that are taken: {sorted(clash)}")
    whole = StructType([*out.fields])
    for n, k in zip(names, keys, strict=True):
        whole = whole.add(n, rows.schema[k].dataType)
    whole = whole.add("_error", "string")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), batch_rows):
                failed = []
                for part, error in call_apart(call, frame.iloc[at : at + batch_rows], tries, again, wait):
                    if error is not None:
                        failed.append((*(part[k].iloc[0] for k in keys), error))
                    elif set(part.columns) != set(result):
                        raise TypeError(f"the function returned {list(part.columns)}, not {result}")
                    elif len(part):
                        yield part[result].assign(**dict.fromkeys([*names, "_error"]))
                if failed:
                    bad = pd.DataFrame(failed, columns=[*names, "_error"]).astype(dict.fromkeys(names, object))
                    yield bad.assign(**dict.fromkeys(result))[[*result, *names, "_error"]]

    table = materialise(rows.mapInPandas(run, whole), "isolated")
    errors = table.filter("_error IS NOT NULL")
    return table.filter("_error IS NULL").select(*result), errors.selectExpr(*(f"{n} AS `{k}`" for n, k in zip(names, keys, strict=True)), "_error AS error")
