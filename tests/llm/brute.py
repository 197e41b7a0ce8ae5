"""Plain helpers the operators are compared with."""


def classes(nodes, linked):
    """Smallest member of each node's class, by repeated lookups; ``linked(a, b)`` says if."""
    nodes = sorted(nodes)
    parent = {node: node for node in nodes}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if root(a) != root(b) and linked(a, b):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {node: root(node) for node in nodes}


def read(spark, sf_dir, name, *columns):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns).collect()
