from __future__ import annotations

import public_tokenizers

PATH = public_tokenizers.path("byte_bpe_50k.json")

#: Null and repeated ids, null, empty and repeated texts, white space of all kinds, one long text.
ODD_DOCUMENTS = [
    (1, "The the cat sat on the mat"),
    (2, "The the cat sat on the mat"),
    (2, "The the cat sat on the mat"),
    (3, None),
    (4, ""),
    (5, " \t\n\x0b "),
    (None, "The the cat sat on the mat"),
    (None, None),
    (6, "été <|endoftext|> naïve\n\n  x" + " y z"),
    (7, "word " * 3000),
    (7, "another text under the same id"),
]


def union_find(nodes, edges):
    parent = {node: node for node in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {node: root(node) for node in nodes}


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()
