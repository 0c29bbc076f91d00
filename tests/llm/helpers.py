"""What the tests of the operators share."""

import re

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode())


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)
