"""Rows that every operator must get over."""

LINE = "A line that is long enough to count"


def edge_rows():
    """(doc_id, text): nulls, empty and blank texts, ties, repeated rows and ids, a very long text."""
    long_text = " ".join(f"word{i % 997} filler{i % 313}" for i in range(40_000))
    return [
        (1, None), (2, ""), (3, " \t\n\x0b "), (None, None), (None, "some words without an id"),
        (4, f"{LINE}\none"), (5, f"  {LINE.upper()}\t\ntwo\n\n"), (6, f"{LINE}\n{LINE}\nthree"),
        (7, "same text"), (8, "same  text"), (9, "sametext"), (9, "sametext"), (9, "another text"),
        (10, "\n"), (11, "one"), (12, "ONE"), (13, "Ünïcode ÄÖ ß   wide\xa0blank"), (14, "x" * 900),
        (15, long_text), (16, long_text + " tail"), (17, f"{LINE}\n end"), (None, f"{LINE}\nfour"),
    ]
