"""Words and odd rows that the tests share."""

import re

WORD = re.compile("[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return (text or "").translate(LOW)


def mirrored(letters):
    """A Thue-Morse word and its mirror."""
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(letters))
    return word, word.translate(str.maketrans("ab", "ba"))


STRANGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "One two three"), (6, "one two three"), (6, "one two three"),
    (None, "no id but words"), (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3),
    (8, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 3), (9, "é ß 漢字 😀   ▁ x" * 5), (10, "w" * 200_000),
    (11, " ".join(f"word{i % 977}" for i in range(60_000))), (12, "NULL\x00byte \x0b\x0c\r end"),
]
