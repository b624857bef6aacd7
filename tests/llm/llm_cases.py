"""A small documents table with the awkward cases, shared by the tests."""

import random

COLUMNS = ("doc_id bigint, text string, lang string, source string, n_chars bigint,"
           " score string, kept string, shard string, n_words string")


def prose(seed: int, words: int, letters: str = "abcdefghiklmnoprstu") -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    base = prose(1, 150)
    words = base.split()
    near = " ".join(words[:40] + ["changed"] + words[41:])
    far = " ".join(words[:60] + prose(2, 90).split())
    passage = prose(3, 60)
    rows = [
        (1, base), (2, base), (3, near), (4, far), (5, None), (6, ""), (7, " \n\t "), (8, "one two"),
        (9, "One TWO"), (None, prose(4, 30)), (None, None), (10, prose(5, 30)), (10, prose(5, 30)),
        (11, prose(6, 100) + " " + passage + " " + prose(7, 80)),
        (12, prose(8, 50) + " " + passage + " " + prose(9, 70)),
        (13, "of " * 400), (14, prose(10, 20000)), (15, "x" * 3000), (16, "é" * 500 + " ñandú über 漢字 " + "é" * 500),
        (17, "line a b\nline a b\nline c\n\nline a b\n"),
        (18, "Released under the MIT License. cc by cc by nc 4.0"),
        (19, prose(11, 40) + "\nLicensed under the Apache License, Version 2.0.\n" + prose(12, 40)),
        (20, "don't  stop here now \x1c\x85 12345 !!! \r\n\r\n   end   "),
    ]
    return rows


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, "en", "hot" if (i or 0) % 3 else "cold", len(t or ""), "s", "k", "h", "w") for i, t in rows], COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
