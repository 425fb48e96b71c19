import pytest

#: Awkward rows: null and empty texts, white space only, a repeated row, a null id, a very long text, one long word.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today.\nSecond line of this first text here.", "en"),
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today.\nSecond line of this first text here.", "en"),
    (2, None, "en"), (3, "", None), (4, " \n\t ", "fr"), (None, "Un texte sans numéro, avec des mots français dedans.", "fr"),
    (5, "word " * 60_000, "en"), (6, "x" * 3000, "de"), (7, "Ärger über 😀   don't 'tis 12345 …!", "de"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    """The awkward rows, with columns named like those that operators use inside or return."""
    frame = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(3)
    extra = ("_text", "_row", "c0", "one", "key", "fp", "line", "id", "range", "node", "IDS", "Fingerprint", "score", "n_words", "n_removed")
    return frame.selectExpr("*", *(f"'{i}' AS `{name}`" for i, name in enumerate(extra)), "'dot' AS `a.b`")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")


@pytest.fixture(scope="session")
def folder():
    return "/root/testdata/sf0.001"
