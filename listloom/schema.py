"""The data model: rule lines, rules, and the character classes that parsing rests on."""

from __future__ import annotations

BLOCK, ALLOW, COMMENT = "block", "allow", "comment"
#: Order of types in a merged list; everything that is neither block nor allow counts as a comment.
TYPE_RANK = {BLOCK: 0, ALLOW: 1}

LINES = "source_idx int, source string, line_no bigint, line string"
CONTENTS = "source_idx int, source string, content string, error string"
SOURCES = "source_idx int, grp string, name string, url string, enabled boolean"
RULE_COLUMNS = ["raw", "domain", "type", "wildcard", "source", "normalized_domain", "ordinal"]

#: White space as Unicode has it: what is stripped from lines, and what a domain cannot hold.
WHITE_SPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WHITE_CLASS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
#: What ends a line: CR LF, or one of LF, VT, FF, CR, FS, GS, RS, NEL, LS, PS.
LINE_BREAK = r"\r\n|[\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"

#: A line's ordinal is its source's index in the high bits and its number in the low ones.
LINE_BITS = 40
