"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from charloom.session import ensure_checkpoint_dir, ship_package

#: ASCII white space, as in the word pattern ``[^\x20\x09-\x0D]+``.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Named columns of a Parquet table; pruning reaches the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def prepare(spark: SparkSession) -> None:
    """Workers can import the package; the shared checkpoint folder is set."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there:
    later jobs neither recompute it nor depend on executors that held it."""
    prepare(df.sparkSession)
    return df.checkpoint()


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A higher-order function evaluates what its lambda refers to for every
    element; a lambda variable is bound once, whatever the optimizer inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def plain_spaces(text: Column, spaces: str = SPACES[1:]) -> Column:
    """Every other white-space character as a blank (one fast pass each)."""
    for c in spaces:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def ascii_words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order.  Splitting at a plain
    blank avoids the regular-expression engine."""
    return F.array_remove(F.split(plain_spaces(text), " "), "")


def word_count(line: Column) -> Column:
    """Number of ASCII words of a line that holds one; blanks are only counted
    where words stand one blank apart."""
    plain = F.trim(plain_spaces(line))
    return let(plain, lambda x: F.when(F.contains(x, F.lit("  ")), F.size(F.array_remove(F.split(x, " "), ""))).otherwise(
        F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) + 1))


def row_key(*cols: Column) -> Column:
    """128-bit identity of a row by its values (nulls told from empty texts).
    Rows that agree in all of them share the key, and so every result."""
    marked = [F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-")) for c in cols]
    return F.md5(F.concat_ws("\x00", *marked))


class Remembered(dict):
    """Values by key, made on first use; forgets everything when full."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value
