"""The ROB report computed row by row in Python, for small inputs."""

from collections import defaultdict
from datetime import timedelta

EXCLUDED_ROOMS = {32, 33}
EXCLUDED_PRICES = {681, 121}
LABELS = {0: "Confirmed", 5: "Tentative"}


def _add(total, value):
    if value is None:
        return total
    return value if total is None else total + value


def rob(versions, hotels, bridge, segments, day):
    """Report rows as a dict from the key columns to (rooms, revenue)."""
    visible = defaultdict(list)
    for row in versions:
        if row[1] is not None and row[1].date() <= day and not (row[1].date() == day and row[1].time().isoformat() != "00:00:00"):
            visible[row[0]].append(row)
    report = {}
    for rows in visible.values():
        newest = max(row[1] for row in rows)
        for row in rows:
            bkg, load, arrival, departure, status, room, rate, other, hotel_id, price, rooms = row
            if load != newest or status not in LABELS or arrival is None or departure is None:
                continue
            if room is None or room in EXCLUDED_ROOMS or price is None or price in EXCLUDED_PRICES:
                continue
            price_per_room = rate if rate is not None else other
            revenue = None if rooms is None or price_per_room is None else rooms * price_per_room
            own_hotels = [h for h in hotels if hotel_id is not None and h[0] == hotel_id] or [(hotel_id, None, None, None)]
            links = [b for b in bridge if bkg is not None and b[0] == bkg] or [(bkg, None)]
            for _, code, inventory, owned in own_hotels:
                for _, segment_id in links:
                    own = [s for s in segments if segment_id is not None and s[0] == segment_id] or [(None, None, None)]
                    for _, source, segment in own:
                        night = max(arrival, day)
                        while night < departure:
                            key = (day, night, hotel_id, code, inventory, source, segment, LABELS[status], owned)
                            old = report.get(key, (None, None))
                            report[key] = (_add(old[0], rooms), _add(old[1], revenue))
                            night += timedelta(days=1)
    return report


def as_dict(report_df):
    """A report frame in the same form; fails if a key occurs twice."""
    keys = ["as_of_date", "stay_date", "hotel_id", "hotel_code", "inventory", "source_nm", "segment_nm",
            "reservation_status", "owned_vs_managed"]
    rows = report_df.collect()
    found = {tuple(row[k] for k in keys): (row["rob"], row["room_revenue"]) for row in rows}
    assert len(found) == len(rows)
    return found
