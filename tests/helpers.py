"""What several test modules share."""

import datetime as dt
import os

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples."""
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=repr)
