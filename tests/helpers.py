"""Brute-force counts in plain Python, for small inputs only."""

import random
from itertools import combinations


def baskets_frame(spark, baskets):
    rows = [(ticket, item) for ticket, items in baskets.items() for item in sorted(items)]
    return spark.createDataFrame(rows, "ticket_id long, item long")


def brute_sets(baskets, size, minimum):
    counts = {}
    for items in baskets.values():
        for chosen in combinations(sorted(items), size):
            counts[chosen] = counts.get(chosen, 0) + 1
    return {k: v for k, v in counts.items() if v >= minimum}


def random_baskets(seed, n_tickets=60, n_items=25, huge=0):
    """Baskets with favourite items, some of them far larger than the rest."""
    rng = random.Random(seed)
    baskets = {}
    for ticket in range(n_tickets):
        size = n_items - rng.randint(0, 5) if ticket < huge else rng.randint(1, 6)
        weights = [1 / (i + 1) for i in range(n_items)]
        baskets[ticket] = set(rng.choices(range(n_items), weights, k=size)) | (
            set(rng.sample(range(n_items), size)) if ticket < huge else set()
        )
    return baskets


def as_dict(df, columns):
    return {tuple(row[c] for c in columns): row["support"] for row in df.collect()}
