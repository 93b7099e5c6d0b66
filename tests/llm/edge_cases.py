"""Rows that the operators have to bear."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "label string, row string, size string, copies string, bucket string, key string, spans string")
WORDS = [f"w{i}" for i in range(400)]


def passage(start, n):
    return " ".join(WORDS[(start * 7 + i * (1 + start % 5)) % 400] + str(start) for i in range(n))


def edge_rows():
    """Nulls in any column, empty and long texts, repeated rows, equal texts,
    shared passages, near copies, periodic text."""
    shared = passage(1, 60)
    base = passage(2, 120)
    near = base.replace("w22 ", "changed ").split()
    near[60] = "other"
    rows = [
        (1, base, "en", "a"), (2, " ".join(near), "en", "a"), (3, base, "en", "b"), (3, base, "en", "b"),
        (4, passage(3, 40) + " " + shared + " " + passage(4, 40), "de", "b"),
        (5, passage(5, 30) + "\n" + shared, "de", None), (6, shared + " " + passage(6, 10), None, "c"),
        (None, passage(7, 70), "fr", "c"), (None, base, "fr", "a"),
        (7, None, "en", "a"), (8, "", "en", "b"), (9, "   \n\t ", None, None), (10, "one two", "en", "a"),
        (11, "ab ab " * 300, "en", "a"), (12, "x" * 3000, "en", "a"), (13, passage(8, 6000), "es", "a"),
        (14, "Ünïcode ß 漢字 é " * 40 + passage(9, 50), "de", "c"), (15, "ONE two", "en", "b"), (16, passage(10, 3), "en", "zz"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), *["x"] * 7) for i, t, lang, s in rows]
