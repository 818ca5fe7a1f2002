"""What a merge makes of stored rows and new ones, as a plain operator."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SET_ALL = "*"
Clause = tuple[str | None, Mapping[str, str] | str]


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all keys, and rows with a null key, which match nothing."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return df.where(~missing), df.where(missing)


def changed_rows(stored: DataFrame | None, source: DataFrame, keys: Sequence[str], matched: Sequence[Clause]) -> DataFrame:
    """The rows that a merge of ``source`` into ``stored`` inserts or changes, in their new state.

    ``matched`` lists ``(condition, assignments)``: the first clause whose condition holds
    sets the row's columns, and a row that meets none stays as it is and is not in the result. Conditions and
    assignments are SQL over ``t`` (stored row) and ``s`` (source row); a None condition
    always holds and ``SET_ALL`` takes every column from ``s``. A key that the source holds
    twice raises an error; null keys match nothing and are inserted. Both sides have the same columns, of the same
    types, and ``stored`` one row of each key. Without ``stored`` every row is inserted.
    """
    columns = source.columns
    keyed, unkeyed = split_null_keys(source, keys)
    once = keyed.groupBy(*keys).agg(F.count("*").alias("_copies"), F.first(F.struct(*columns)).alias("s"))
    row_type = once.schema["s"].dataType
    complaint = F.concat(F.lit("source holds a key more than once: "), F.to_json(F.struct(*keys)))
    s = once.select(F.when(F.col("_copies") > 1, F.raise_error(complaint).cast(row_type)).otherwise(F.col("s")).alias("s"))
    if stored is None:
        return s.select("s.*").unionByName(unkeyed)

    t = stored.select(F.struct(*columns).alias("t"))
    pairs = s.join(t, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "left")
    new = F.col("t").isNull()
    tests = [~new if condition is None else ~new & F.expr(condition) for condition, _ in matched]

    def value(column: str) -> Column:
        result = F.when(new, F.col(f"s.{column}"))
        for test, (_, assignments) in zip(tests, matched):
            if assignments == SET_ALL:
                result = result.when(test, F.col(f"s.{column}"))
            else:
                # A clause sets all of its row, so columns it does not name keep their value.
                result = result.when(test, F.expr(assignments[column]) if column in assignments else F.col(f"t.{column}"))
        return result

    touched = new
    for test in tests:
        touched = touched | F.coalesce(test, F.lit(False))
    states = pairs.where(touched).select(*[value(f.name).cast(f.dataType).alias(f.name) for f in source.schema])
    return states.unionByName(unkeyed)
