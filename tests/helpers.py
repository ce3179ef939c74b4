def rows(df, *columns):
    """Rows as sorted tuples; nulls sort first."""
    found = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda r: tuple((x is not None, str(type(x)), x) if not
                  isinstance(x, (list, dict)) else (True, "", str(x)) for x in r))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
