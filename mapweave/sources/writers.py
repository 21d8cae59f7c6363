"""CSV output, one output per target table, and database loading."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Null and "" are both blank, and quotes are doubled.
CSV_FORMAT = {"sep": ",", "quote": '"', "escape": '"', "emptyValue": ""}


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """Replace ``path`` by a directory of CSV part files, each with the header."""
    df.write.csv(path, mode="overwrite", header=header, **CSV_FORMAT)


def write_report(df: DataFrame, path: str) -> None:
    """A report is CSV without a header."""
    write_csv(df, path, header=False)


def write_tables(tables: dict[str, DataFrame], directory: str) -> None:
    """One output per target table, under ``tables/<name>``."""
    for name, df in tables.items():
        write_csv(df, f"{directory}/tables/{name}")


def load_tables(
    tables: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None
) -> None:
    """Append every table to the existing database table of the same name.

    Each partition is one transaction; cap the number of connections with the
    ``numPartitions`` property.
    """
    for name, df in tables.items():
        df.write.jdbc(url, name, mode="append", properties=properties or {})
