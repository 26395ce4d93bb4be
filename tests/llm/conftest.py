import pytest

from tabulon.sources.tables import read_table

#: Texts at the edges: null, empty, white space, one word, few words, ties and copies.
EDGES = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two three."),
    (6, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (7, "A b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y changed"),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y changed"),
    (None, "null ids have a text too, of their own kind, that nobody else has in the table"),
    (None, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (9, "ünï cödé wörds ÀÉÎ straße 漢字 😀 ends"),
    (10, "line one is here\nline one is here\n\nlast line"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Edge texts, with extra columns whose names clash with what operators add."""
    names = ("score kept n_words lines items batch bucket _h _s _row label cls component "
             "start n_tokens").split()
    df = spark.createDataFrame(EDGES, "doc_id long, text string")
    return df.selectExpr("*", *[f"'x' as `{n}`" for n in names]).repartition(3)


@pytest.fixture(scope="session")
def no_docs(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").cache()


@pytest.fixture(scope="session")
def long_text():
    """Half a million words on one line."""
    return " ".join(f"w{i % 7919}" for i in range(500_000))
