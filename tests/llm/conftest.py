import datetime

import pytest

LONG = "ab" * 60_000 + " the of end " + "x y " * 3_000

#: Null and empty texts, white space only, very long ones, repeated rows, null ids and sources, columns named like added ones.
ROWS = [
    (1, "The cat sat on the mat with the hat of a man", "en", "s1", 5), (1, "The cat sat on the mat with the hat of a man", "en", "s1", 5),
    (2, None, None, None, None), (3, "", "en", "s1", 0), (4, " \t\n \r\x0b", "en", None, 5), (5, LONG, "en", "s2", 1),
    (None, "Der Hund und die Katze sind in dem Haus", "de", "s2", 3), (None, None, None, None, None),
    (7, "12345 67890 !!! ???", None, "s3", 2), (8, "日本語 🙂 ÄÖÜ ñandú\n\nline\nline", "xx", "s3", 4),
    (9, "The cat sat on the mat with the hat of a man", "en", "s1", 5), (10, "é", "fr", "", 1),
]
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, score string, key string, size string, part int, fp string, "
          "`kept_text` string, spans string, ids string, `odd name.x` date, Lang_Pred string, kept string, fingerprint string, target string, s string, "
          "__out string, __mark string, __key string, __hash2 string, __letter string, __drops string, `out` string, `far` string, mark string, letter string, "
          "stay_key string, text_hash string, nth string")
EXTRA = ("clash", "clash", "clash", 7, "clash", "clash", "clash", "clash", datetime.date(2020, 1, 1), "clash", "clash", "clash", "clash", "clash", *["kept as it is"] * 13)


@pytest.fixture(scope="session")
def awkward(spark):
    return spark.createDataFrame([(*r, *EXTRA) for r in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts():
    return [r[1] or "" for r in ROWS]


@pytest.fixture(scope="session")
def docs_small(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
