"""Landed search responses for tests, written by us, and the rows they must give."""

import json
from datetime import datetime, timedelta

DAYS = ("2031-07-02", "2031-07-03")
SEARCHED = ("2031-07-02", "2031-07-24")


def golden_row(day, i):
    """Made by rule: one flight three times, one trip with two stops, one with unlike carriers."""
    often = (day, i) in ((0, 0), (0, 2), (1, 4))
    flight = "100" if often else str(200 + 20 * day + i)
    leaves = "21:10" if often else f"{5 + i:02d}:{5 * i:02d}"
    stops = [("MMA", 500), ("MMB", 75)] if (day, i) == (0, 2) else [(f"M{i % 5}M", 40 + 15 * i)]
    operating = "Carrier X" if (day, i) == (1, 1) else f"Carrier {i % 4}"
    return (DAYS[day], f"it-{day}-{i}", flight, f"{40 + i},{100 + 37 * i + day}",
            f"{SEARCHED[day]}T{leaves}:00", 1500 if len(stops) > 1 else 900 + 10 * i,
            f"Carrier {i % 4}", operating, stops)


# fetch date, itinerary id, flight, price, departure, duration, marketing, operating, stops
GOLDEN = [golden_row(day, i) for day in range(2) for i in range(10)]

MARK = "₹ "


def segment(flight, origin, destination, departure, arrival, marketing="M", operating="O"):
    return {
        "id": f"{origin}-{destination}-{departure}",
        "origin": {"displayCode": origin, "name": origin, "type": "Airport"},
        "destination": {"displayCode": destination, "name": destination, "type": "Airport"},
        "departure": departure, "arrival": arrival, "durationInMinutes": 120,
        "flightNumber": flight,
        "marketingCarrier": {"id": -1, "name": marketing},
        "operatingCarrier": {"id": -2, "name": operating},
    }


def leg(leg_id, codes, departure="2025-01-01T10:00:00", duration=600, waits=None,
        flight="1", marketing="M", operating="O", carriers=None):
    """A leg along ``codes``; each flight takes two hours, each wait as told (an hour)."""
    at, segments = datetime.fromisoformat(departure), []
    for i, (a, b) in enumerate(zip(codes, codes[1:])):
        landed = at + timedelta(minutes=120)
        segments.append(segment(flight if i == 0 else "205", a, b, at.isoformat(),
                                landed.isoformat(), marketing, operating))
        at = landed + timedelta(minutes=(waits or [60] * len(codes))[i]
                                if waits is None or i < len(waits) else 0)
    made = {"id": leg_id, "departure": departure, "arrival": at.isoformat(),
            "durationInMinutes": duration, "stopCount": len(codes) - 2, "segments": segments,
            "carriers": {"marketing": [{"id": -1, "name": marketing}], "operationType": "x"}}
    if carriers:
        made["carriers"]["operating"] = [{"id": -2, "name": carriers}]
    return made


def itinerary(name, legs, price="100"):
    return {"id": name, "price": {"raw": float(price.replace(",", "")) - 0.4,
                                  "formatted": MARK + price, "pricingOptionId": "p"},
            "legs": legs, "isSelfTransfer": False, "fareAttributes": {}, "score": 0.5,
            "farePolicy": {"isChangeAllowed": False}}


def envelope(itineraries, status="incomplete"):
    return {"data": {"context": {"status": status, "sessionId": "s",
                                 "totalResults": len(itineraries)},
                     "itineraries": itineraries, "messages": [], "token": "t",
                     "filterStats": {"duration": {"min": 1, "max": 2}}},
            "status": True, "message": "Successful"}


def land(base, day, name, *envelopes):
    folder = base / day
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(json.dumps(e) + "\n" for e in envelopes))
    return str(base)


def golden_itinerary(row):
    _, name, flight, price, departure, duration, marketing, operating, stops = row
    codes = ["AAA", *[s for s, _ in stops], "ZZZ"]
    made = leg(name, codes, departure, duration, [w for _, w in stops], flight,
               marketing, operating, operating if operating != marketing else None)
    return itinerary(name, [made], price)


def write_golden(base):
    days = {d: [golden_itinerary(r) for r in GOLDEN if r[0] == d]
            for d in DAYS}
    land(base, "2031-07-01", "result.json", envelope([], "failure"))
    land(base, "2031-07-02", "result.json", envelope(days["2031-07-02"]))
    land(base, "2031-07-03", "2031-07-24.json", envelope(days["2031-07-03"]))
    return str(base)


def golden_summary():
    """The eleven columns of each expected row, sorted."""
    return sorted(
        (day, flight, MARK + price, departure, duration, marketing, operating, "AAA", "ZZZ",
         ", ".join(s for s, _ in stops), len(stops))
        for day, _, flight, price, departure, duration, marketing, operating, stops in GOLDEN)


def golden_waits():
    return sorted((day, name, i, stop, wait) for day, name, *_, stops in GOLDEN
                  for i, (stop, wait) in enumerate(stops))
