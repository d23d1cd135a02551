"""Line dedup by hand."""

from collections import defaultdict


def by_hand(docs):
    """(doc_id, n_lines, n_removed, kept text) of each row; among rows of equal id that share windows, texts must be equal."""
    order = sorted(docs, key=lambda d: (d[0] is None, d[0] if d[0] is not None else 0))
    places = defaultdict(list)
    for at, (_, t) in enumerate(order):
        lines = t.split("\n") if t is not None else []
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if "".join(w).strip(" "):
                places[w].append((at, k))
    gone = defaultdict(set)
    for p in places.values():
        for at, k in p[1:]:
            gone[at] |= {k, k + 1, k + 2}
    out = []
    for at, (i, t) in enumerate(order):
        lines = t.split("\n") if t is not None else []
        out.append((i, len(lines), len(gone[at]), None if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone[at])))
    return out
