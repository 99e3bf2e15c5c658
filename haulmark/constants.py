"""Numbers and codes that carry business meaning.

Most are the default of a keyword argument where they are used, so a caller
with other codes passes their own.
"""

from __future__ import annotations

# Purchase-order, load and log states.
PO_RECEIVED = 9
PO_EXCLUDED = 8
LOAD_EXCLUDED = 32
LOG_CLOSED_STATES = ("RCV", "DEL")
PENDING_ROUTES = ("PEND", "PND")
APPOINTMENT_VOID_STATES = (14, 15)
REVENUE_ORDER = "Revenue PO"
SIDE_STREAM_ORDER_TYPE = 1

# Carriers.
BACKHAUL_CARRIER = 78
NEVER_UNBILLED_CARRIERS = (78, 1680, 2496, 1704)
NEVER_ALLOCATED_CARRIERS = (78, 1680, 2629, 69, 2616, 3122)
CROSSDOCK_SHUTTLE_CARRIERS = (4541,)
CONSOLIDATION_WAREHOUSES = (22, 23, 20)
NOT_A_REAL_BILL_CARRIER = 66

# Pallet sizing limits.
PALLET_WEIGHT_RANGE = (250, 1200)
PALLET_CUBE_RANGE = (25, 100)
CUBES_PER_PALLET = 50
MAX_PALLETS = 26

# Shipping methods of a form's vendor row.
BACKHAUL, BACKHAUL_CROSSDOCK, DIRECT, VSP, DIRECT_CROSSDOCK = 1, 2, 3, 4, 5

# Allowance types.
NO_ALLOWANCE, PERCENT_ALLOWANCE = 1, 4

# Source systems and the region each one stands for.
DEFAULT_SYSTEM = "DEFAULT"
EAST_SYSTEM = "UBS"
WEST_SYSTEM = "WBS"
CONVENTIONAL_SYSTEM = "UCS"
BUDGET_SYSTEMS = ("UBS", "WBS", "ALB", "TFF", "TMW")
REGION_NAMES = {"UBS": "EAST", "WBS": "WEST", "ALB": "ALBERT'S", "TFF": "TONY'S"}

# Warehouse groups that share a blended rate, with list codes.
BLEND_WAREHOUSES = {
    "gilroc": (1, 114),
    "harcar": (168, 169),
    "stksgm": (160, 214),
    "annser": (178, 186),
}
BLEND_CODES = {"gilroc": 1, "harcar": 2, "stksgm": 3, "annser": 4, "east": 5}
BLENDS = ("east", "gilroc", "harcar", "stksgm", "annser")
YORK_WAREHOUSE = 12
DRY_TEMPERATURE = 3

# Form states.
NEW = 53
SRM_SUBMIT = 54
SRM_VENDOR_CONFIRMATION = 55
SRM_CONFIRMATION = 56
IBL_SUBMIT = 57
IBL_INITIAL_ANALYSIS = 58
IBL_PRICING = 59
IBL_FINAL_ANALYSIS = 60
BACKHAUL_ANALYSIS = 61
CLOSING = 62
REJECTED_VSP = 65
COMPLETED = 66
VSP_CONFIRMATION = 67

# Pickup day numbers, 0 = Monday.
PICKUP_DAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
