"""Job arguments that name months."""


def month_list(month=None, months=None, all_months=False):
    """`all_months`, a range `"1-6"`, a list `"1,3,6"` or one month, in that order of precedence."""
    if all_months:
        chosen = list(range(1, 13))
    elif months and "-" in months:
        first, last = months.split("-")
        chosen = list(range(int(first), int(last) + 1))
    elif months:
        chosen = [int(m) for m in months.split(",")]
    elif month:
        chosen = [month]
    else:
        raise ValueError("name a month, a list of months, or all months")
    if any(m < 1 or m > 12 for m in chosen):
        raise ValueError(f"months run from 1 to 12: {chosen}")
    return chosen


def monthly_paths(root, year, month=None):
    """File pattern of one month, or of all months of a year."""
    part = f"{month:02d}" if month else "*"
    return f"{root}/{year}/flights_{year}_{part}.csv"
