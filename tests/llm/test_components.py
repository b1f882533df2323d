import random

from llm_fixtures import rows, table  # noqa: F401

from stratalake.llm.components import components


def by_hand(links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    return sorted((x, root(x)) for x in parent)


GRAPHS = {
    "path": [(i, i + 1) for i in range(70)],
    "path backwards": [(100 - i, 99 - i) for i in range(60)],
    "star": [(50, i) for i in range(49)] + [(50, 60)],
    "cycle and pair": [(i, (i + 1) % 9) for i in range(9)] + [(-5, -7)],
    "random": [(random.Random(i).randrange(60), random.Random(i + 999).randrange(60)) for i in range(45)],
    "loops and copies": [(1, 1), (2, 3), (3, 2), (2, 3)],
}


def test_smallest_node_reachable(table):
    links = [(a + 1000 * n, b + 1000 * n) for n, graph in enumerate(GRAPHS.values()) for a, b in graph]
    found = components(table([*links, (1, None), (None, None)], "a long, b long"))
    assert sorted(rows(found, "node", "component")) == by_hand(links)


def test_no_links(table):
    assert components(table([], "a long, b long")).count() == 0
