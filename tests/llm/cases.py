"""Documents with every awkward shape: nulls, empty and long texts, ties, repeated rows, extra columns."""
import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


def sentence(rnd, n):
    return " ".join("".join(rnd.choice(["an", "er", "th", "ou", "ï", "st", "ea"]) for _ in range(rnd.randint(1, 4))) for _ in range(n))


def edge_rows(seed=3):
    rnd = random.Random(seed)
    shared = sentence(rnd, 80)
    long = " ".join(sentence(rnd, 40) + "." for _ in range(400))
    texts = [None, "", " \n\t ", "a", "word", "é" * 120, shared, shared, "x " + shared + " y", sentence(rnd, 5) + "\n" + shared,
             long, long[: len(long) // 2] + " tail", "ab " * 300, "ab " * 300, "line one\n" * 70, "%%% $$$ " * 60,
             "no\x00zero \x1c here   wide space <|endoftext|> it's 12²", "\U0001f600" * 60, shared[:99], shared[:100], shared[:101]]
    rows = [(i, t, rnd.choice(["en", "de", None]), rnd.choice(["s0", "s0", None]), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[6], rows[10], (None, shared, "en", "s0", 9), (None, None, None, None, None), (-5, shared, "en", "s1", 3)]
    rnd.shuffle(rows)
    return rows


def edge_docs(spark, n=3):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(n)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def shas(*values):
    import hashlib

    return tuple(hashlib.sha256(v if isinstance(v, bytes) else v.encode()).hexdigest() for v in values)
