import pytest

SMALL = "/root/testdata/sf0.001"

SCHEMA = ("doc_id long, text string, lang string, source string, score double, shard int, "
          "slot long, key string, kept string, node int, removed_spans string, row int, "
          "class string, held_out string, label int, _size string, _g string, _r string, "
          "_k string, _part string, _at string, _kept string, _repeated string, _cut string, "
          "_row string, _all string, copy string, starts string")


#: Values that an operator must give back as they are.
MINE = {n: f"mine {n}" for n in ("_size", "_g", "_r", "_k", "_part", "_at", "_kept", "_repeated",
                                 "_cut", "_row", "_all", "copy", "starts")}


def unharmed(rows) -> bool:
    """Have all rows their clashing columns still?"""
    return all(r[n] == value for r in rows for n, value in MINE.items())


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (id, text[, lang]) with columns whose names clash with those
    that operators use or return."""
    def of(rows):
        rows = [(*r, None)[:3] for r in rows]
        return spark.createDataFrame(
            [(i, t, g, None, 0.5, 7, 9, "k", "x", 1, "s", 2, "c", "h", 3, *MINE.values())
             for i, t, g in rows], SCHEMA)
    return of


@pytest.fixture(scope="session")
def odd():
    """Nulls, empty and long texts, copies and repeated rows."""
    long = " ".join(f"word{i} runs by the river" for i in range(9000))
    story = ("a quiet morning came over the harbour and the boats went out one by one "
             "while the keeper of the light counted them and wrote their names down")
    return [(1, story), (2, story), (2, story), (3, None), (None, story), (None, None),
            (4, ""), (5, "   \n "), (6, long), (7, "x"), (8, "x"), (9, "12 34 5.6 !!"),
            (10, "naïve 😀 İstanbul ﬁn   end"), (None, "only null id")]
