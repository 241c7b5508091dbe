"""Slow one-record-at-a-time resolution: the truth for the distributed operators."""

import re
from hashlib import md5

from leadloom.constants import DESCRIPTOR_WORDS, LEGAL_WORDS

LEGAL = r"\b(" + "|".join(LEGAL_WORDS) + r")\b"
DESCRIPTORS = r"\b(" + "|".join(DESCRIPTOR_WORDS) + r")\b"


def squeeze(text):
    return " ".join(text.split())


def fuzzy_norm(name):
    return squeeze(re.sub(LEGAL, " ", re.sub(r"[^\w\s]", " ", name.lower())))


def norm(name):
    text = re.sub(LEGAL, " ", re.sub(r"[^\w\s]", " ", name.lower()))
    return squeeze(re.sub(DESCRIPTORS, " ", text))


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], prev + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def ratio(a, b):
    if not a and not b:
        return 100.0
    return 200.0 * lcs(a, b) / (len(a) + len(b))


def token_sort_ratio(a, b):
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def phone_key(phone):
    digits = re.sub(r"\D", "", phone or "")
    return md5(f"phone:{digits[-10:]}".encode()).hexdigest() if len(digits) >= 10 else None


def identity_key(name, phone, website):
    if phone_key(phone):
        return phone_key(phone)
    site = re.sub(r"^https?://", "", (website or "").lower().strip()).rstrip("/")
    text = f"name:{norm(name)}" + (f"|web:{site}" if site else "")
    return md5(text.encode()).hexdigest()


def resolve(records, registry=(), threshold=90, log=None):
    """Returns [(seq, key, match_type, matched_name, score)] in arrival order."""
    nodes = [dict(key=k, name=n, norm=m) for k, n, m in registry]
    out = []
    for rec in sorted(records, key=lambda r: r["seq"]):
        raw = rec["company_name"] or ""
        stored = raw.strip() or "Unknown"
        phone = (rec.get("phone") or "").strip()
        pk = phone_key(phone)
        hit = next((n for n in nodes if pk and n["key"] == pk), None)
        if hit:
            out.append((rec["seq"], hit["key"], "phone", hit["name"], None))
            continue
        best = None
        for n in nodes:
            if threshold > 100 or not n["norm"].startswith(norm(stored)[:3]):
                continue
            score = token_sort_ratio(fuzzy_norm(raw), fuzzy_norm(n["name"]))
            if log is not None:
                log.append((rec["company_name"], n["name"], round(score, 6)))
            if score >= threshold and (best is None or (-score, n["name"]) < best[:2]):
                best = (-score, n["name"], n["key"])
        if best:
            out.append((rec["seq"], best[2], "fuzzy", best[1], -best[0]))
            continue
        key = identity_key(raw, phone, rec.get("website"))
        hit = next((n for n in nodes if n["key"] == key), None)
        if hit:
            out.append((rec["seq"], key, "key", hit["name"], None))
            continue
        nodes.append(dict(key=key, name=stored, norm=norm(stored)))
        out.append((rec["seq"], key, None, None, None))
    return out
