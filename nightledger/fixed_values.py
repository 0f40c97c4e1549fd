"""Values fixed by the reports themselves: results are only right with exactly these."""

# --- fixed values -----------------------------------------------------------

# Reservation statuses that count as booked, and the labels reports show for them.
BOOKED_STATUSES = [0, 5]
STATUS_LABELS = {"0": "Confirmed", "5": "Tentative"}

# Room types and price groups that never count (pseudo rooms, house accounts).
EXCLUDED_ROOM_TYPES = [32, 33]
EXCLUDED_PRICE_GROUPS = [
    19955, 19956, 23022, 8899, 17929, 23170, 23441, 23442, 23443, 23444, 23445,
    23446, 23447, 23448, 23449, 23450, 23451, 23455, 23456, 23508, 681, 121,
]

# Hotel codes the coarse report shows under another code.
HOTEL_RECODES = {"RFHDL1": "LTHDL", "KSHPP": "KPHPN"}

# Text that stands for NULL in landed files.
NULL_MARKERS = ["NaN", "nan", "@NULL@", "NULL"]

# Text form of business dates in the daily hotel fact.
BUSINESS_DATE_FORMAT = "dd-MM-yyyy"

# Rows per JDBC insert batch.
JDBC_BATCH_ROWS = 100000

# --- end of fixed values ----------------------------------------------------
