import os

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: Names that operators use themselves, as further columns of the input.
CLASHES = "kept score lang_pred shard slot size n_lines n_dropped component_id n_shingles page word text_crc32 bands node _id"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("no driver tables here")
    return SF


def texts():
    word = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    prose = " ".join(word[i * i % 12] + str(i) for i in range(80))
    near = prose.replace("alpha0", "other")
    return [
        prose, prose, near, None, "", " \t\n ", "one", "Zwei Wörter", "\n\n", "#$% & | <>", "a a a a a a", "ｗｉｄｅ  text here",
        "line one\nLINE ONE \nshared line\n", " ".join(f"w{i % 97}x{i}" for i in range(30_000)), "é é \x1c x'S don't İ",
        "<|endoftext|> stays", *[f"shared line\nown {i}\n\nSHARED line " for i in range(12)],
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Null and repeated ids, null, empty, very long and equal texts, columns with clashing names."""
    rows = [(i, text, ("en", "de", None)[i % 3], "s", 0) for i, text in enumerate(texts())]
    rows += [rows[0], rows[4], (None, "a text without id", "en", None, None), (None, None, None, None, None)]
    clash = [f"`{name}` string" for name in CLASHES.split()]
    data = [(*row, *["x"] * len(clash)) for row in rows]
    return spark.createDataFrame(data, ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *clash]))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


def listed(df):
    return [row.asDict(recursive=True) for row in df.collect()]
