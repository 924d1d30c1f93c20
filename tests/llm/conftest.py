import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from paidpath.session import build_session, ensure_checkpoint_dir
    s = build_session("local[4]", app="llm-tests", shuffle_partitions=4, driver_memory="6g")
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    return s


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, extra columns with
    clashing names."""
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", "en", "s", 4), (4, "one two three", "en", "s", 13),
            (4, "one two three", "en", "s", 13), (5, "word " * 30_000, "en", "s", 150_000), (None, "the text without id", "en", None, 19),
            (6, "the text without id", None, "s", 19), (7, "!!! ??? 12", "de", "s", 10), (8, "x" * 50_000, "de", "s", 50_000)]
    return spark.createDataFrame([(*r, 9, 9, 9) for r in rows], SCHEMA + ", shard int, n_words int, score int")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
