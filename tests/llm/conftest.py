import pytest

#: Texts every operator has to take: null, empty, blanks, repeats, ties, and a long one.
AWKWARD = [None, "", " \t\n", "one", "One", "one two three", "one  two\tthree", "é ü 漢字 😀",
           "x" * 5000, "a b c d e f g h i j k l", "a b c d e f g h i j k l"]
CLASHES = "doc_id long, text string, row string, sha string, fp string, score double, items string, maybe string"


@pytest.fixture
def awkward(frame):
    """Documents with null and repeated ids, and columns whose names operators might use themselves."""
    rows = [(k if k % 4 else None, t, "r", "s", "f", 0.5, "i", "m") for k, t in enumerate(AWKWARD)]
    long = " ".join(f"w{k % 977}" for k in range(60_000))
    rows += [(7, long, "r", "s", "f", 0.5, "i", "m")] * 2
    return frame(rows, CLASHES)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], CLASHES)
