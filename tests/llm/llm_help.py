def bag(items):
    """A multiset that also orders nulls."""
    return sorted(map(repr, items))
