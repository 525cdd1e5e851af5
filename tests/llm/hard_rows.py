"""Documents that are hard on the operators, and invented prose."""

WORDS = "amber birch cedar delta ember fjord grove heron inlet jetty knoll larch mossy north ochre pines quill ridge slate tidal".split()


def prose(seed: int, n: int) -> str:
    """n pseudo-random words, a line of about 12 each."""
    x, out = seed * 2654435761 + 12345, []
    for i in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) % 2**64
        out.append(WORDS[(x >> 33) % len(WORDS)] + str((x >> 40) % 97))
        out.append("\n" if i % 12 == 11 else " ")
    return "".join(out).strip()


LONG = prose(1, 30_000)
BASE = prose(2, 120)
NEAR = BASE.replace(BASE.split()[40], "changed", 1)
MIT = "Some work. Released under the MIT License.\nUnder the MIT license, under the mit license"

#: (doc_id, text, lang): nulls, empty, white space, symbols, copies, near copies, repeated rows, a very long text.
EDGE = [
    (1, "", "en"), (2, None, None), (3, " \n\t\r ", "en"), (4, "one two", "en"), (5, "one two", None), (6, LONG, "en"),
    (7, BASE, "en"), (8, NEAR, "en"), (9, BASE, "en"), (9, BASE, "en"), (10, "123 … !!! 456", "en"),
    (11, MIT, "de"), (None, "a text without an id, " + prose(3, 30), "en"), (12, prose(4, 60) + "\n" + BASE.split("\n")[3], "de"),
    (13, LONG + "\nand an end of its own with some more words", "en"), (14, "É" * 40 + "\n" + "é" * 39 + "É", "fr"), (15, "x", "en"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row int, rest int, doc string, key string, id long, n int, token string"
