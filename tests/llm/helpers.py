"""A small table of documents with every awkward case, and brute-force helpers."""

import hashlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = " \t\n\x0b\x0c\r"

LONG = "wort und satz " * 5000 + "ende"
AWKWARD = [
    (1, "the cat sat on the mat\nCopyright line \nthe end", "en", "src0", 10),
    (2, "the cat sat on the mat\n copyright LINE\nanother end", "en", "src0", 10),
    (3, None, "en", "src1", None),
    (4, "", None, "src1", 0),
    (5, "   \t\n\n  ", "de", None, 7),
    (6, LONG, "de", "src2", len(LONG)),
    (7, LONG, "de", "src2", len(LONG)),
    (8, "12345 67890 !!!", "fr", "src3", 15),
    (9, "École Ünïcode ẞtraße İstanbul ΣΑΣ 数据 😀 á x y", "fr", "src3", 40),
    (9, "École Ünïcode ẞtraße İstanbul ΣΑΣ 数据 😀 á x y", "fr", "src3", 40),
    (None, "the cat sat on the mat\nCopyright line \nthe end", None, None, None),
    (None, None, None, None, None),
    (12, "<|endoftext|> don't stop, it's 3.14 o'clock!", "en", "src0", 45),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return (text or "").encode().lower().split()


def components(nodes, links):
    """Smallest node reachable, by node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}
