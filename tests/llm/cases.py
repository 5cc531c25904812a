"""Small hand-made documents for the operators' tests: nulls, empty and long texts, ties, repeats, clashing names."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])

SHARED = "This line of boiler plate stands in many documents."
LONG = " ".join(f"word{i % 997} Größe naïve" for i in range(30_000))


def rows(seed=7, n=60):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7))) for _ in range(80)]
    out = []
    for i in range(n):
        text = "\n".join(" ".join(rnd.choice(vocab) for _ in range(rnd.randint(3, 14))) + "." for _ in range(rnd.randint(1, 6)))
        if i % 3 == 0:
            text += "\n  " + (SHARED.upper() if i % 2 else SHARED) + "\t"
        out.append((i, text, rnd.choice(["en", "de", None]), "src0" if i % 3 else f"src{i % 5}", len(text)))
    base = out[5]
    out += [(100 + i, base[1], "en", "src0", None) for i in range(8)]  # exact copies
    out += [(120 + i, base[1] + f" tail{i}", "en", "src0", None) for i in range(4)]  # near copies
    out += [(130, None, None, None, None), (131, "", "en", "src1", 0), (132, " \t\n\r ", "en", "src1", 5),
            (133, LONG, "de", "src1", len(LONG)), (134, "a b", "en", None, 3), (135, "a b", "fr", None, 3),
            (136, "x y   z\x1c q\u0085r", "en", "src1", 9), (137, "\n\n" + SHARED + "\n\n", "en", "src1", 60),
            (None, SHARED, "en", "src1", None), (None, None, None, None, None),
            out[0], out[0], (3, "other text of a known id " * 3, "en", "src2", None)]  # repeated rows and ids
    return out


def frame(spark, data=None, parts=5):
    return spark.createDataFrame(data if data is not None else rows(), SCHEMA).repartition(parts)
