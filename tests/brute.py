"""The job written as plain Python over lists: the brute-force reference."""

from datetime import timedelta


def visit_map(cus, msg, lo=None, hi=None, both=False, hi_closed=True):
    """cus: (cid, start, end, day, guids); msg: (cid, account, app, source, device, day).

    Window on the end day (datetime): [lo, hi] when ``hi_closed``, else [lo, hi).
    Returns a set of the 8 dedupe columns + report date.
    """
    def inside(d):
        if lo is None:
            return True
        return d is not None and lo <= d and (d <= hi if hi_closed else d < hi)

    out = set()
    for cid, start, end, day, guids in cus:
        if cid is None or not inside(day):
            continue
        for mcid, account, app, source, device, mday in msg:
            if mcid != cid or (both and not inside(mday)):
                continue
            key = None if account is None else f"{account}-{cid}"
            rpt = None if day is None else (day - timedelta(hours=7)).date()
            for g in (guids if guids else [None]):
                out.add((key, start, end, day, app, source, device, g, rpt))
    return out
