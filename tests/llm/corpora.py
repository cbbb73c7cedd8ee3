"""Small tables with what every operator must stand: nulls, empty and long texts, ties, repeated rows, clashing column names."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, fp long, key string, part string, component_id long, words int, kept boolean, pattern int, src string, node long"
PAGES = "page_id long, url string, html string, text string, n_chars long, tag string"
BENCH = "item_id long, text string, similarity double"
ITEM = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the river bank"


def prose(seed: int, words: int = 80) -> str:
    rnd = random.Random(seed)
    pool = [a + b for a in "ba ce di fo gu la me ni ro su ta ve".split() for b in ("", "lan", "mir", "sto", "ver", "dun")]
    out = []
    while len(out) < words:
        n = rnd.randint(6, 14)
        out.append(" ".join(rnd.choice(pool) for _ in range(n)).capitalize() + ".")
    return "\n".join(out) if seed % 2 else " ".join(out)


def rows():
    long = prose(99, 30_000)
    texts = {
        1: prose(1), 2: prose(2), 3: prose(3), 4: None, 5: "", 6: " \n\t ", 7: prose(1), 8: prose(1).replace("Ba", "Zu", 1), 9: long, 10: "x", 11: prose(4) + "\n" + ITEM + "\n" + prose(5),
        12: "word " * 300, 13: "THE!! BAD!! THING!! " * 60, 14: "a | b | c | d | " * 40, 15: "\x00 é 中文 😀 ​ " + prose(6), 16: prose(7) + " call +1 (706) 555-3138 or bo@ex.org, 10.1.2.3", 17: prose(8) + "\nReleased under the MIT License.",
        18: "0" * 5000, 19: "\n" * 200, 20: prose(9),
    }
    sources = ["b", "a", None, "", "b"]
    out = [(i, t, "en", sources[i % 5], None, 1, 2, "k", "p", 3, 4, True, 5, "s", 6) for i, t in texts.items()]
    out += [out[1], out[1], (None, prose(3), None, None, None, None, None, None, None, None, None, None, None, None, None), (None, None, *[None] * 13), (2, prose(20), "en", "a", *[None] * 11)]
    return out


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def benchmark(spark):
    return spark.createDataFrame([(1, ITEM, 0.5), (2, None, None), (None, "", 1.0), (3, "x", None), (4, prose(50, 20), None), (1, ITEM, 0.1)], BENCH)
