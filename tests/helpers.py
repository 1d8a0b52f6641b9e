"""Paths and file writers that the tests share."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def write_lines(path, lines, bom=False, crlf=False):
    end = "\r\n" if crlf else "\n"
    text = end.join(lines) + end
    with open(path, "w", encoding="utf-8", newline="") as f:
        if bom:
            f.write("﻿")
        f.write(text)
    return str(path)
