"""Small document tables and plain reference versions of the operators."""

import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A table like ``documents`` with one column more whose name could clash."""
    full = [(i, t, None, "s", None if t is None else len(t)) for i, t in rows]
    return spark.createDataFrame(full, DOCS).selectExpr("*", "1 as score", "'x' as key", "2 as n")


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingles(text, words):
    found = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
    if len(found) < words:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)}


def linked_components(rows, words, percent):
    """Sorted (doc_id, shingles, smallest id reachable) by comparing all pairs."""
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        ids = [doc_id, least.get(find(i))]
        least[find(i)] = min([x for x in ids if x is not None], default=None)
    return sorted(
        ((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))), key=repr
    )
