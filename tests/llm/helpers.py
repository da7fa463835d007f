"""Small tables shared by the operator tests."""

import random

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Ünïcode ß 日本 word. word."), (6, "same text here"),
       (6, "same text here"), (7, "same text here"), (None, "a row without an id"), (8, "x" * 5000),
       (9, "long " * 4000), (10, "<|endoftext|> </s> [INST] & < |"), (11, "\x00 \x1c odd \x85 white space")]

#: Columns named like outputs and internals of the operators.
CLASHES = ("ids", "decoded", "sequence_id", "offset", "length", "piece", "start", "shard", "slot", "size", "fp", "tag",
           "measures", "removed", "kept", "kept_text", "spans", "k0", "block", "n_words", "at", "g", "node", "bytes")


def documents(spark, rows, clashes=()):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for c in clashes:
        from pyspark.sql import functions as F
        df = df.withColumn(c, F.lit(f"own {c}"))
    return df


def full_documents(spark, rows, clashes=()):
    from pyspark.sql import functions as F
    return documents(spark, rows, clashes).select(
        "doc_id", "text", F.lit("en").alias("lang"), F.lit("src0").alias("source"),
        F.char_length("text").cast("long").alias("n_chars"), *clashes)


def prose(seed: int, n: int, words: int = 60) -> list[tuple[int, str]]:
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéiorst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    return [(100 + i, " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ",\n"])
                               for _ in range(rng.randint(1, 2 * words)))) for i in range(n)]
