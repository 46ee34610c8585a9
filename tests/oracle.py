"""A plain Python version of the rules of parsing and deduplication, written for the tests."""

import re

FORMATS = [
    ("comment", re.compile(r"!")),
    ("cosmetic", re.compile(r"#@?#")),
    ("allow", re.compile(r"@@\|\|([^/^\s]+)\^")),
    ("block", re.compile(r"\|\|([^/^\s]+)\^")),
    ("hosts", re.compile(r"(?:0\.0\.0\.0|127\.0\.0\.1)\s+(\S+)\Z")),
    ("plain", re.compile(r"(?:[a-zA-Z0-9][-a-zA-Z0-9]*\.)+[a-zA-Z]{2,}\Z")),
]


def parse(line):
    """(raw, domain, type, wildcard) or None."""
    line = line.strip()
    for name, pattern in FORMATS:
        if not line or not (m := pattern.match(line)):
            continue
        if name == "comment":
            return line, "", "comment", False
        if name == "cosmetic":
            return None
        if name == "plain":
            return f"||{line.lower()}^", line.lower(), "block", False
        domain = m[1]
        if name == "hosts" and domain.lower() in ("localhost", "localhost.localdomain"):
            return None
        return line, domain, "allow" if name == "allow" else "block", domain.startswith("*.")
    return None


def key(rule):
    d = rule[1].lower()
    return rule[2], d[2:] if d.startswith("*.") else d


def deduplicate(rules):
    """Surviving rules in order."""
    out = []
    for kind in ("block", "allow"):
        slots = {}
        for r in rules:
            if r[2] == kind and (key(r) not in slots or r[3] and not slots[key(r)][3]):
                slots[key(r)] = r
        wild = {k[1] for k, r in slots.items() if r[3]}
        for (_, domain), r in slots.items():
            labels = domain.split(".")
            if r[3] or not any(".".join(labels[i:]) in wild for i in range(len(labels))):
                out.append(r)
    return out + list({r[0]: r for r in reversed([r for r in rules if r[2] not in ("block", "allow")])}.values())[::-1]
