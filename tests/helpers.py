from datetime import date


def rows(df, *columns):
    """Rows as a sorted list of tuples, missing values last."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()),
        key=lambda t: tuple((v is None, str(v)) for v in t),
    )


def d(month, day, year=2014):
    return date(year, month, day)
