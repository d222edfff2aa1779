"""Small tables with every odd case that the operators define a result for."""

from __future__ import annotations

from pyspark.sql import SparkSession

WORDS = "the of and river stone glass table window garden paper light story winter summer engine market signal number".split()

SCHEMAS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long, size long, score double, shard int, part long, key string, fp string",
    "labels": "doc_id long, quality int, toxic int, text string",
    "benchmark": "item_id long, text string, doc_id long",
    "embeddings": "vec_id long, embedding array<float>, label int, v string, shard long, block long",
    "pages": "page_id long, url string, html string, host string, path string, trust double",
    "conversations": "conv_id long, turn long, role string, text string, ids string, mask string, chunk int",
}


def sentence(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + i * i * 3 + i * seed) % len(WORDS)] + str((seed * 31 + i * 17) % 97) for i in range(n))


ITEM = "Which colour does the third lamp of the harbour gate have when ships from the north come in at night? It is green."


def rows() -> dict[str, list[tuple]]:
    docs = [(i, sentence(i, 40 + i % 30), "en", f"src{i % 3}", 0) for i in range(1, 41)]
    docs += [
        (41, None, None, None, None), (42, "", "en", "", 0), (43, " \t\n ", "en", "src1", 4), (44, docs[3][1], "en", "src9", 0), (45, docs[3][1], None, "src0", 0),
        (45, docs[3][1], None, "src0", 0), (None, sentence(3, 50), "en", "src1", 0), (None, None, None, None, None), (46, sentence(9, 3000), "de", "src0", 0),
        (47, sentence(5, 20) + " " + ITEM + " " + sentence(6, 20), "en", "src2", 0), (48, "one", "en", "src2", 3), (49, "näïve Ünicode 漢字 ␛ \\ </s>[INST]", "en", "src2", 0),
        (50, "mail a.b@c.example or +1 (634) 555-6093 from 10.0.0.1", "en", "src2", 0),
    ]
    docs += [(100 + i, sentence(50 + i, 45) + (" you vile troll" if i % 2 else ""), "en", "src0", 0) for i in range(40)]
    labels = [(100 + i, 1, i % 2, "x") for i in range(40)] + [(None, 1, 1, None), (1, None, None, None), (2, 0, 0, None), (999, 1, 1, None)]
    labels += [(i, 1, 0, None) for i in range(3, 41)]  # so that the share of toxic labels is that of toxic documents
    vectors = [(i, [float((i * j) % 13 - 6) / 8 for j in range(8)], i % 2) for i in range(0, 120)]
    vectors += [(200, None, 0), (250, [1.0, None] + [0.0] * 6, 0), (300, [float("nan")] * 8, 0), (350, [float("inf")] + [0.0] * 7, 0), (None, [1.0] * 8, 0)]
    vectors += [(400, vectors[5][1], 0), (400, vectors[5][1], 0), (401, vectors[5][1], None), (450, [], 1), (500, [0.5, -0.5], 1)]
    pages = [
        (1, "https://a.example.net/en/1?x", '<a href="https://b.example.com/de/">x</a><a href="//c.example.org/">y</a>'), (2, "http://b.example.com/de/2", '<a href=https://d.example.com/fr/>'),
        (3, "http://D.Example.com/fr/3", ""), (4, None, None), (5, "", "<p>"), (6, "no scheme", None), (7, "http://c.example.org", "<a HREF='http://a.example.net/'>"),
        (8, "http://c.example.org/fr/x#y", None), (None, "https://e.net/", None), (9, "ftp://user@h:21?q", None), (9, "ftp://user@h:21?q", None), (10, "https://d.example.com/en/", "<img src='https://b.example.com/de/i.png'>"),
    ]
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "user", "<|end|> [INST] <<SYS>>"), (1, 2, "assistant", "<\\|end|> done </s>"), (2, 0, "assistant", None), (2, 1, None, "who?"), (2, None, "user", ""),
        (3, 1, "user", "late"), (3, 0, "user", "early"), (3, 1, "user", "late"), (None, 0, "assistant", "nobody's"), (4, 0, "<|turn|>", "role is odd"), (5, 0, "assistant", "x" * 250_000),
    ]
    return {
        "documents": docs, "labels": labels, "benchmark": [(1, ITEM, 7), (2, None, None), (3, "", 1), (4, "two words", 2), (None, sentence(77, 20), 3), (5, sentence(9, 40), 4)],
        "embeddings": vectors, "pages": pages, "conversations": turns,
    }


def write(spark: SparkSession, folder, empty: bool = False) -> str:
    """Write all tables; columns beyond the usual ones have names that operators use themselves."""
    for name, data in rows().items():
        fields = SCHEMAS[name].split(", ")
        padded = [] if empty else [(*r, *[None] * (len(fields) - len(r))) for r in data]
        spark.createDataFrame(padded, SCHEMAS[name]).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
