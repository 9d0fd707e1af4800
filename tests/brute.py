"""Row-by-row retelling of the rules, for small tables only."""


def _order(rows):
    return sorted(rows, key=lambda r: (r["source_fiscal"], r["id"]))


def duplicates(rows):
    """id -> (via, keeper)."""
    out = {}
    work = _order([r for r in rows if not r["gen_is_error"] and r["source_fiscal"] is not None])
    rules = [
        (1, ["gen_vendor_normalized", "raw_contract_date"]),
        (2, ["gen_vendor_normalized", "reference_number", "gen_start_year"]),
        (3, ["reference_number"]),
    ]
    for row in work:
        if row["id"] in out:
            continue
        for via, keys in rules:
            keys = ["owner_acronym", "contract_value", *keys]
            found = [
                r for r in work if r["id"] not in out and all(r[k] == row[k] for k in keys)
            ]
            for other in found[1:]:
                out[other["id"]] = (via, found[0]["id"])
    return out


def amendments(rows):
    """id -> (is_amendment, group)."""
    out = {}
    work = _order(
        [
            r
            for r in rows
            if not r["gen_is_error"] and not r["gen_is_duplicate"] and r["source_fiscal"] is not None
        ]
    )
    for row in work:
        if row["id"] in out:
            continue
        found = [
            r
            for r in work
            if r["id"] != row["id"]
            and r["id"] not in out
            and r["owner_acronym"] == row["owner_acronym"]
            and r["gen_vendor_normalized"] == row["gen_vendor_normalized"]
            and (
                r["reference_number"] == row["reference_number"]
                or (
                    r["original_value"] == row["contract_value"]
                    and r["gen_start_year"] == row["gen_start_year"]
                )
            )
        ]
        if found:
            out[row["id"]] = (False, row["id"])
            for r in found:
                out[r["id"]] = (True, row["id"])
    return out


def _end(row):
    start, end = row["gen_start_year"] or 0, row["gen_end_year"] or 0
    if end < start:
        return max(start, row["source_year"] or start)
    return end


def effective(rows):
    """id -> (start, end, total, yearly, original, most_recent) for all valid rows."""
    out = {}
    valid = [
        r
        for r in rows
        if not r["gen_is_error"] and not r["gen_is_duplicate"] and r["source_fiscal"] is not None
    ]
    groups = {}
    for r in valid:
        if r["gen_amendment_group_id"] is None:
            if r["gen_start_year"] is None or r["gen_end_year"] is None:
                out[r["id"]] = (None, None, None, None, None, False)
                continue
            end = _end(r)
            value = r["contract_value"]
            out[r["id"]] = (
                r["gen_start_year"],
                end,
                value,
                value / (end - r["gen_start_year"] + 1),
                r["original_value"] or value,
                True,
            )
        else:
            groups.setdefault(r["gen_amendment_group_id"], []).append(r)
    for members in groups.values():
        members.sort(key=lambda r: (r["source_fiscal"], r["contract_value"], r["id"]))
        if not any(
            r["gen_start_year"] is not None and r["gen_end_year"] is not None for r in members
        ):
            for r in members:
                out[r["id"]] = (None, None, None, None, None, False)
            continue
        starts = [r["gen_start_year"] for r in members if r["gen_start_year"] is not None]
        originals = [r["original_value"] for r in members if r["original_value"] is not None]
        original = min(originals) if originals else None
        original = original or min(r["contract_value"] for r in members)
        owner = {}
        for position, r in enumerate(members):
            low = (r["gen_start_year"] or 0) if position == 0 else (r["source_year"] or 0)
            for year in range(min(starts), _end(members[-1]) + 1):
                if low <= year <= _end(r):
                    owner[year] = r["id"]
        spent, first = 0.0, True
        for r in members:
            mine = [y for y, who in owner.items() if who == r["id"] and y != 0]
            if not mine:
                out[r["id"]] = (None, None, 0.0, 0.0, None, False)
                continue
            low = r["gen_start_year"] or 0 if first else r["source_year"]
            rate = (r["contract_value"] - spent) / (_end(r) - low + 1)
            length = max(mine) - min(mine) + 1
            total = rate * length
            spent += total
            first = False
            out[r["id"]] = (
                min(mine),
                max(mine),
                total,
                total / length,
                original,
                r is members[-1],
            )
    return out
