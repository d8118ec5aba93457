"""The identity rules read record after record, held in memory: what the waves are tested against."""

import math
from collections import defaultdict
from dataclasses import dataclass, field
from itertools import product
from types import SimpleNamespace

from tractloom.functions.canonical import LOCATION_DOMAIN, QUARANTINE_DOMAIN, hexdigest
from tractloom.functions.coordinates import EARTH_RADIUS_M
from tractloom.operators.identity import AMBIGUOUS, ANCHOR, BAND_M, NEW, ORDER, PROBABLE, PROBABLE_M, REASONS, SAME


def arc(p: tuple[float, float], q: tuple[float, float]) -> float:
    """Metres between two points (latitude, longitude) on the sphere; NaN if a coordinate is."""
    a, b = math.radians(p[0]), math.radians(q[0])
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(q[1] - p[1]) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))


def cube(point: tuple[float, float]) -> tuple[int, int, int] | None:
    """The cube of edge BAND_M that holds a point of the sphere."""
    if math.isnan(point[0]) or math.isnan(point[1]):
        return None
    lat, lon = map(math.radians, point)
    xyz = math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)
    return tuple(math.floor(EARTH_RADIUS_M * v / BAND_M) for v in xyz)


def cubes_around(point: tuple[float, float]):
    """The 27 cubes that hold everything within BAND_M of a point."""
    home = cube(point)
    if home is not None:
        for step in product((-1, 0, 1), repeat=3):
            yield tuple(c + d for c, d in zip(home, step, strict=True))


def point_of(row) -> tuple[float, float]:
    return row.latitude, row.longitude


@dataclass(eq=False)
class Place:
    """Earlier records taken for one location: what later ones are compared with."""

    number: int
    vintage: float
    anchor: SimpleNamespace
    points: dict[tuple, SimpleNamespace] = field(default_factory=dict)  # the first record at each
    addresses: set[str] = field(default_factory=set)
    towns: set[tuple] = field(default_factory=set)

    def corroborates(self, row) -> bool:
        return bool((row.address_norm and row.address_norm in self.addresses) or (row.city_norm and row.zip_norm and (row.city_norm, row.zip_norm) in self.towns))


@dataclass
class Sight:
    """How a record stands to a place that is near or akin to it."""

    distance: float = math.inf
    nearest: SimpleNamespace | None = None
    exact: bool = False
    akin: bool = False
    conflict: bool = False  # akin to a record of the place that is farther than BAND_M

    @property
    def stable(self) -> bool:
        return self.akin and not self.conflict


class Atlas:
    """The resolved places of a block by cube, seed and address, and all records of each vintage by cube."""

    def __init__(self, rows: list) -> None:
        self.cubes, self.seeds, self.addresses, self.peers = defaultdict(list), defaultdict(dict), defaultdict(dict), defaultdict(list)
        for r in rows:
            self.peers[r.vintage_year, cube(point_of(r))].append(r)

    def add(self, place: Place, row) -> None:
        at = point_of(row)
        if at not in place.points:
            place.points[at] = row
            if (home := cube(at)) is not None:
                self.cubes[home].append((place, at))
        for index, name in ((self.seeds, row.seed_norm), (self.addresses, row.address_norm)):
            if name:
                index[name][place, at] = None
        if row.address_norm:
            place.addresses.add(row.address_norm)
        if row.city_norm and row.zip_norm:
            place.towns.add((row.city_norm, row.zip_norm))

    def seen_from(self, row) -> dict[Place, Sight]:
        """Every place within BAND_M of a record or akin to it."""
        here, found = point_of(row), defaultdict(Sight)
        for home in cubes_around(here):
            for place, at in self.cubes.get(home, ()):
                d = arc(here, at)
                if d <= BAND_M:
                    sight = found[place]
                    if d < sight.distance:
                        sight.distance, sight.nearest = d, place.points[at]
                    sight.exact |= at == here
        for index, name in ((self.seeds, row.seed_norm), (self.addresses, row.address_norm)):
            for place, at in index.get(name, ()) if name else ():
                sight = found[place]
                sight.akin = True
                sight.conflict |= arc(here, at) > BAND_M
        return found

    def alone_nearest(self, row, place: Place) -> bool:
        """Of the records of its vintage, this one alone is nearest to the place; it is within PROBABLE_M of it."""
        near: dict[int, tuple[float, SimpleNamespace]] = {}
        for at in place.points:
            for home in cubes_around(at):
                for peer in self.peers.get((row.vintage_year, home), ()):
                    d = arc(point_of(peer), at)
                    if id(peer) not in near or d < near[id(peer)][0]:
                        near[id(peer)] = d, peer
        least = min(d for d, _ in near.values())
        nearest = [p for d, p in near.values() if math.isclose(d, least, rel_tol=0.0, abs_tol=1e-9)]
        return len(nearest) == 1 and nearest[0] is row


def equal_at_coarser(a, b) -> bool:
    lat, lon = min(a.latitude_precision, b.latitude_precision), min(a.longitude_precision, b.longitude_precision)
    return round(a.latitude, lat) == round(b.latitude, lat) and round(a.longitude, lon) == round(b.longitude, lon)


def judged(row, atlas: Atlas) -> tuple[str, str, Place | None]:
    """State, reason and place (None for a new one) of a record, by the rules in their order."""
    sights = atlas.seen_from(row)
    exact, stable = [p for p, s in sights.items() if s.exact], [p for p, s in sights.items() if s.stable]
    if len(exact) == 1 and not sights[exact[0]].conflict:
        return SAME, "exact", exact[0]
    if len(stable) == 1:
        return SAME, "stable", stable[0]
    prior = {p: s for p, s in sights.items() if p.vintage < row.vintage_year and s.nearest is not None}  # records come by vintage
    likely = [
        p for p, s in prior.items()
        if s.distance <= PROBABLE_M and not s.conflict and p.corroborates(row) and equal_at_coarser(row, s.nearest) and atlas.alone_nearest(row, p)
    ]
    if len(likely) == 1 and all(s.distance > prior[likely[0]].distance for p, s in prior.items() if p is not likely[0]):
        return PROBABLE, "probable", likely[0]
    in_band = any(s.distance > PROBABLE_M for s in prior.values())
    if exact or stable or len(likely) > 1 or in_band or any(s.conflict for s in sights.values()):
        return AMBIGUOUS, "ambiguous", None
    return NEW, "new", None


def by_order(row: dict) -> list[tuple]:
    """Sort key of ORDER, nulls last."""
    return [(row[c] is None, 0 if row[c] is None else row[c]) for c in ORDER]


def lineage_of(row) -> tuple:
    return row.source_workbook_identity, row.source_sheet, row.source_row, row.source_seed_point_id


def resolve_block(records: list[dict]) -> list[dict]:
    """The records of a block in order, each with its decision, its location's id and anchor."""
    records = sorted(records, key=by_order)
    unknown = {"latitude": math.nan, "longitude": math.nan, "vintage_year": math.nan}  # nulls are violations; here they are near to nothing
    rows = [SimpleNamespace(**r | {c: v for c, v in unknown.items() if r[c] is None}) for r in records]
    atlas, decided = Atlas(rows), []
    for row in rows:
        state, why, place = judged(row, atlas)
        if place is None:
            place = Place(len(decided), row.vintage_year, row)
        elif row.vintage_year == place.vintage and lineage_of(row) < lineage_of(place.anchor):
            place.anchor = row
        if state != AMBIGUOUS:
            atlas.add(place, row)
        decided.append((state, REASONS[why], place))
    out = []
    for record, (state, why, place) in zip(records, decided, strict=True):
        resolved = state != AMBIGUOUS
        decision = {"identity_state": state, "identity_rule_reason_code": why, "physical_location_id": location_id(place.anchor) if resolved else quarantine_id(place.anchor)}
        out.append(record | decision | {f"anchor_{c}": getattr(place.anchor, c) if resolved else None for c in ANCHOR})
    return out


def location_id(anchor) -> str:
    named = {k: getattr(anchor, k) for k in ("source_workbook_identity", "source_sheet", "source_seed_point_id", "latitude", "longitude")}
    return f"ploc-{hexdigest({'domain': LOCATION_DOMAIN, 'source_row': int(anchor.source_row), **named})[:24]}"


def quarantine_id(anchor) -> str:
    lineage = [anchor.source_workbook_identity, anchor.source_sheet, int(anchor.source_row), anchor.source_seed_point_id]
    return f"qloc-{hexdigest({'domain': QUARANTINE_DOMAIN, 'lineage': lineage})[:24]}"
