"""Small inputs for the tests of the training-data operators."""

import random

WORDS = "the of and to a in is that for it was on with as by an this from nterri onthe ereath bleson tiored anshth".split()

DOCS = "doc_id long, text string, lang string, source string"


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + (rng.choice(".,") if rng.random() < 0.1 else "") for _ in range(n))


def odd_texts() -> list:
    """Null, empty, blank, one word, repeated, not Latin, very long without and with spaces."""
    return [
        None, "", " \n\t ", "word", prose(1, 60), prose(1, 60), "İstanbul ΣΑΣ naïve 日本語 👩‍👩‍👧 \x85z\x0bq \x1c y", "x" * 50_000,
        prose(2, 20_000), "a<|endoftext|>b  \n<|endoftext|> x", "\nThis\n\n  foo \n bar\t\tx  ", "don't you'LL 's 123,456!!!???",
    ]


def odd_docs(spark, extra: str = ""):
    """The odd texts, with null and repeated ids and languages, and columns whose names operators use."""
    rows = [(k if k not in (3, 6) else None, t, "en" if k % 3 else None, f"src{k % 4}" if k % 5 else None) for k, t in enumerate(odd_texts())]
    docs = spark.createDataFrame(rows + rows[4:6], DOCS)
    return docs.selectExpr("*", *(f"'clash' AS {c}" for c in extra.split())) if extra else docs


def no_docs(spark):
    return spark.createDataFrame([], DOCS)
