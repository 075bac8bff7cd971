import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def rows(df, *columns):
    """Rows as sorted tuples, doubles rounded."""
    if columns:
        df = df.select(*columns)
    found = [tuple(plain(v) for v in r) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, str(v)) for v in r))


def by(df, key, value):
    return {r[key]: plain(r[value]) for r in df.collect()}
