"""Business constants: score weights, date formats, state centroids, display names."""

from __future__ import annotations

from dataclasses import dataclass, field

EARTH_RADIUS_KM = 6371.0
UNKNOWN_CATEGORY = "Unknown"
ONLINE_CHANNEL = "online transaction"
TRUE_TOKENS = ("YES", "TRUE", "1")

# Date layouts in the order they are tried. Numbers may be padded or not; an ambiguous
# a/b/yyyy is read month first.
#   yyyy-M-d H:m:s
#   yyyy-M-d
#   M/d/yyyy H:m
#   M/d/yyyy
#   d/M/yyyy H:m
#   d/M/yyyy
YEAR_FIRST_DATE = r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2})?$"
YEAR_LAST_DATE = r"^(\d{1,2})/(\d{1,2})/(\d{4})( \d{1,2}:\d{1,2})?$"

# Reason tokens, in the order they are joined.
REASON_ONLINE = "online"
REASON_AMOUNT = "monto_alto"
REASON_ERROR = "error_en_transaccion"
REASON_USER_AMOUNT = "monto_atipico_usuario"
REASON_DARK_WEB = "tarjeta_en_dark_web"
REASON_DISTANCE = "distancia_inusual"

# Display names.
CARD_TYPE_NAMES = {
    "Credit": "Crédito",
    "Debit": "Débito",
    "Debit (Prepaid)": "Débito (Prepago)",
    "Prepaid": "Prepago",
}
DAY_NAMES = ("Dom", "Lun", "Mar", "Mié", "Jue", "Vie", "Sáb")

# Geographic centre (latitude, longitude) of the 50 US states and DC.
STATE_CENTROIDS = (
    ("AL", 32.806671, -86.791130),
    ("AK", 61.370716, -152.404419),
    ("AZ", 33.729759, -111.431221),
    ("AR", 34.969704, -92.373123),
    ("CA", 36.116203, -119.681564),
    ("CO", 39.059811, -105.311104),
    ("CT", 41.597782, -72.755371),
    ("DE", 39.318523, -75.507141),
    ("DC", 38.897438, -77.026817),
    ("FL", 27.766279, -81.686783),
    ("GA", 33.040619, -83.643074),
    ("HI", 21.094318, -157.498337),
    ("ID", 44.240459, -114.478828),
    ("IL", 40.349457, -88.986137),
    ("IN", 39.849426, -86.258278),
    ("IA", 42.011539, -93.210526),
    ("KS", 38.526600, -96.726486),
    ("KY", 37.668140, -84.670067),
    ("LA", 31.169546, -91.867805),
    ("ME", 44.693947, -69.381927),
    ("MD", 39.063946, -76.802101),
    ("MA", 42.230171, -71.530106),
    ("MI", 43.326618, -84.536095),
    ("MN", 45.694454, -93.900192),
    ("MS", 32.741646, -89.678696),
    ("MO", 38.456085, -92.288368),
    ("MT", 46.921925, -110.454353),
    ("NE", 41.125370, -98.268082),
    ("NV", 38.313515, -117.055374),
    ("NH", 43.452492, -71.563896),
    ("NJ", 40.298904, -74.521011),
    ("NM", 34.840515, -106.248482),
    ("NY", 42.165726, -74.948051),
    ("NC", 35.630066, -79.806419),
    ("ND", 47.528912, -99.784012),
    ("OH", 40.388783, -82.764915),
    ("OK", 35.565342, -96.928917),
    ("OR", 44.572021, -122.070938),
    ("PA", 40.590752, -77.209755),
    ("RI", 41.680893, -71.511780),
    ("SC", 33.856892, -80.945007),
    ("SD", 44.299782, -99.438828),
    ("TN", 35.747845, -86.692345),
    ("TX", 31.054487, -97.563461),
    ("UT", 40.150032, -111.862434),
    ("VT", 44.045876, -72.710686),
    ("VA", 37.769337, -78.169968),
    ("WA", 47.400902, -121.490494),
    ("WV", 38.491226, -80.954453),
    ("WI", 44.268543, -89.616508),
    ("WY", 42.755966, -107.302490),
)
US_STATES = tuple(code for code, _, _ in STATE_CENTROIDS)


@dataclass(frozen=True)
class ScoreRules:
    """Points per signal and the cut-offs that fire them (all strict except ``threshold``)."""

    online: int = 3
    # (amount above, points), highest band first
    amount_bands: tuple[tuple[int, int], ...] = field(default=((500, 4), (200, 3), (100, 1)))
    error: int = 1
    user_amount: int = 2
    dark_web: int = 5
    online_expensive: int = 3
    online_expensive_above: int = 200
    distance: int = 2
    distance_above_km: int = 500
    high_amount_above: int = 100
    threshold: int = 4
    user_quantile: float = 0.99

    @property
    def max_score(self) -> int:
        return (
            self.online
            + max(points for _, points in self.amount_bands)
            + self.error
            + self.user_amount
            + self.dark_web
            + self.online_expensive
            + self.distance
        )


DEFAULT_RULES = ScoreRules()
