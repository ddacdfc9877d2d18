"""Small tables: edge cases and texts with planted copies."""

import random

SF = "/root/testdata/sf0.001"
TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
UNIGRAM = "/opt/tokenizers/piece_bpe_32k.model"

#: further columns with names that the operators use themselves
CLASHING = ["row", "node", "hash", "id", "g", "found", "block", "words", "kept", "component", "_hits", "doc", "key", "n", "shard"]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          + ", ".join(f"{c} string" for c in CLASHING))

VOCABULARY = ["".join(random.Random(n).choices("abcdeéñ", k=4)) for n in range(400)]


def prose(seed, n):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


def texts():
    """(doc_id, text): prose, copies, near copies, shared passages, odd texts."""
    out, passage = [], prose(1, 70)
    for i in range(60):
        t = prose(100 + i, 40 + 7 * i)
        if i % 6 == 0:
            t = f"{prose(i, 20)} {passage}\n{prose(i + 1, 30)}"
        if i % 10 == 3:
            t = out[-1][1]  # a copy
        if i % 10 == 5:  # a near copy
            w = out[-2][1].split()
            w[len(w) // 2] = "changed"
            t = " ".join(w)
        out.append((i, t))
    odd = ["", " \t\n", "one", "One two", "a a a a a a a a a a", prose(7, 12000),
           "line with words\nline with words\n\n \nother", "#tag *star* $1 % & | <b>", "İstanbul ΣΑΣ ﬁn 東京 😀 \x00\x1c\x85 x",
           "!!!", "\U0001F600 é‍"]
    return out + [(100 + n, t) for n, t in enumerate(odd)]


def edge_rows():
    rows = [(i, t, "en", f"src{i % 3}", len(t)) for i, t in texts()]
    rows += [(200, None, None, None, None), (None, "null id here", "en", None, 3), (201, None, "de", "src1", 0),
             (None, None, None, None, None), rows[5], rows[5]]
    return [r + ("x",) * len(CLASHING) for r in rows]


def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", 0) + ("x",) * len(CLASHING) for i, t in pairs], SCHEMA).repartition(3)
