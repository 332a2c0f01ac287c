"""Plain-Python results for small inputs."""

import re
import zlib


def lower(text):
    return (text or "").translate({i: i + 32 for i in range(65, 91)})


def words(text):
    return [w for w in re.split("[ \t\n\x0b\x0c\r]+", lower(text)) if w]


def components(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


#: (doc_id, text): null, empty, blank, one long text, ties, copies, odd blanks and letters.
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "one two"), (6, "One two"),
    (7, "The cat sat on the mat. " * 700), (8, "The cat sat on the mat. " * 700), (9, "a\tb\x0bc\x0cd\re\n\nf  g"),
    (10, "Straße ÉCLAIR naïve 日本語 emoji 😀 x"), (11, "<|endoftext|> 12a3 don't 3½"), (12, "x" * 30_000),
    (13, "first line of some length to compare here\nsecond line of some length to compare there"),
    (14, "First line of some length to compare here\nanother line that nobody else has got at all"),
    (15, "first line of some length to compare hare\n\nshort"), (16, "mail a.b@c.de or 4111 1111 1111 1111"),
    (16, "mail a.b@c.de or 4111 1111 1111 1111"), (None, "a row without an id"), (None, None),
]


def odd_frame(spark):
    """The odd rows with further columns whose names operators use inside."""
    rows = [(i, t, "x", 1, [1], "k") for i, t in ODD]
    return spark.createDataFrame(
        rows, "doc_id long, text string, n_words string, class int, dropped_lines array<int>, _key string")


def empty_frame(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_chars long")
