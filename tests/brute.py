"""Plain definitions, computed pair by pair, to hold the operators against."""

from __future__ import annotations

import re
from itertools import combinations


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def similarity(a, b):
    if a is None or b is None:
        return 0.0
    a, b = a.strip(" ").lower(), b.strip(" ").lower()
    longer = max(len(a), len(b))
    return 1 - levenshtein(a, b) / longer if longer else 1.0


def features(x, y, blank_emails=False):
    def clean(email):
        return None if email is None else email.strip(" ").lower()

    def digits(phone):
        return re.sub(r"\D", "", phone or "")

    ex, ey = clean(x["email"]), clean(y["email"])
    px, py = digits(x["phone"]), digits(y["phone"])
    return {
        "name_sim": similarity(x["name"], y["name"]),
        "city_sim": similarity(x["city"], y["city"]),
        "email_exact": float(ex is not None and ex == ey and (blank_emails or ex != "")),
        "phone_exact": float(px != "" and px == py),
    }


def block(r):
    parts = [
        None if r["name"] is None else r["name"].lower()[:1],
        None if r["city"] is None else r["city"].lower()[:3],
    ]
    return "|".join(p for p in parts if p is not None)


def block_pairs(records):
    return [
        (x, y) if x["record_id"] < y["record_id"] else (y, x)
        for x, y in combinations(records, 2)
        if block(x) == block(y) and x["record_id"] != y["record_id"]
    ]


def matches(records, scorer, blank_emails=False):
    found = {}
    for x, y in block_pairs(records):
        f = features(x, y, blank_emails)
        score = 0.0
        for name, weight in scorer.weights.items():
            score = score + weight * f[name]
        score = score / scorer.total
        if score >= scorer.threshold:
            found[x["record_id"], y["record_id"]] = score
    return found


def components(nodes, edges):
    label = {}

    def find(x):
        label.setdefault(x, x)
        while label[x] != x:
            x = label[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        if a != b:
            label[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
