"""Numbers, names and tables that results depend on.

Everything here is a default; each operator takes it as an argument.
"""

from __future__ import annotations

# ---- fixed values: matching ------------------------------------------------
EARTH_RADIUS_M = 6_371_000
RADIUS_M = 250
GEO_WEIGHT = 0.5
CAT_WEIGHT = 0.5

# ---- fixed values: quality rules -------------------------------------------
LAT_BOUNDS = (39.5, 40.5)
LON_BOUNDS = (-76.0, -74.5)
ZIP_PREFIX = "191"
EVENT_PLACES = 4
FUZZY_THRESHOLD = 80

# ---- fixed values: sentiment -----------------------------------------------
POSITIVE_AT = 0.05
NEGATIVE_AT = -0.05
NEGATION_FACTOR = -0.74
BOOSTER_DAMPING = (1.0, 0.95, 0.9)
CONTRAST_WORDS = ("but",)
CONTRAST_BEFORE = 0.5
CONTRAST_AFTER = 1.5
NORMALISATION_ALPHA = 15
NEVER_SO_FACTOR = 1.25
# words of the rules that span several words
PHRASES = {
    "least": ("least",), "before least": ("at", "very"),
    "never": ("never",), "so": ("so", "this"),
    "without": ("without",), "doubt": ("doubt",),
    "no": ("no",), "no link": ("or", "nor"),
    "kind": ("kind",), "of": ("of",),
}

# ---- fixed values: labels ----------------------------------------------------
UNCATEGORIZED = "Uncategorized"
UNKNOWN = "unknown"
OTHER = "Other"

MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# later entries win over earlier ones
BUSINESS_GROUPS = ("Restaurant", "Retail", "Service")

# ---- fixed values: request file layout ---------------------------------------
REQUEST_COLUMNS = (
    "objectid", "service_request_id", "subject", "status", "status_notes",
    "service_name", "service_code", "agency_responsible", "service_notice",
    "requested_datetime", "updated_datetime", "expected_datetime",
    "closed_datetime", "address", "zipcode", "media_url", "lat", "lon",
)
REQUEST_DROPPED = (
    "media_url", "expected_datetime", "updated_datetime",
    "closed_datetime", "status", "service_notice",
)

# ---- fixed values: category groups, in the order that decides the primary one --
CATEGORY_GROUPS = (
    "Food & Restaurants", "Shopping & Retail", "Health & Medical",
    "Beauty & Spas", "Automotive", "Home Services", "Professional Services",
    "Entertainment & Arts", "Active Life & Fitness", "Hotels & Travel",
    "Education", "Pets", "Religious Organizations",
    "Local & Community Services",
)

# ---- fixed values: affinity of request types to category groups ----------------
# (heading, request type, category group, score)
AFFINITY: tuple[tuple[str, str, str, float], ...] = (
    ("Vehicles", "abandoned vehicle", "Automotive", 1.0),
    ("Vehicles", "abandoned vehicle", "Local & Community Services", 0.2),
    ("Vehicles", "abandoned bike", "Active Life & Fitness", 0.7),
    ("Vehicles", "abandoned bike", "Local & Community Services", 0.3),
    ("Vehicles", "traffic signal emergency", "Automotive", 0.7),
    ("Vehicles", "traffic signal emergency", "Local & Community Services", 0.4),
    ("Vehicles", "traffic (other)", "Automotive", 0.6),
    ("Vehicles", "traffic (other)", "Local & Community Services", 0.3),
    ("Vehicles", "traffic calming request", "Automotive", 0.5),
    ("Vehicles", "traffic calming request", "Local & Community Services", 0.4),
    ("Vehicles", "stop sign repair", "Automotive", 0.4),
    ("Vehicles", "stop sign repair", "Local & Community Services", 0.5),
    ("Vehicles", "line striping", "Automotive", 0.4),
    ("Vehicles", "line striping", "Local & Community Services", 0.5),
    ("Sanitation / waste", "rubbish/recyclable material collection", "Food & Restaurants", 0.4),
    ("Sanitation / waste", "rubbish/recyclable material collection", "Home Services", 0.5),
    ("Sanitation / waste", "rubbish/recyclable material collection", "Local & Community Services", 0.4),
    ("Sanitation / waste", "illegal dumping", "Home Services", 0.5),
    ("Sanitation / waste", "illegal dumping", "Local & Community Services", 0.6),
    ("Sanitation / waste", "sanitation violation", "Food & Restaurants", 0.8),
    ("Sanitation / waste", "sanitation violation", "Health & Medical", 0.4),
    ("Sanitation / waste", "sanitation violation", "Shopping & Retail", 0.3),
    ("Sanitation / waste", "dumpster violation", "Food & Restaurants", 0.5),
    ("Sanitation / waste", "dumpster violation", "Home Services", 0.5),
    ("Sanitation / waste", "dumpster violation", "Local & Community Services", 0.3),
    ("Sanitation / waste", "sanitation / dumpster violation", "Food & Restaurants", 0.6),
    ("Sanitation / waste", "sanitation / dumpster violation", "Home Services", 0.5),
    ("Sanitation / waste", "dead animal in street", "Local & Community Services", 0.5),
    ("Sanitation / waste", "dead animal in street", "Pets", 0.4),
    ("Sanitation / waste", "inlet cleaning", "Local & Community Services", 0.6),
    ("Sanitation / waste", "inlet cleaning", "Home Services", 0.3),
    ("Sanitation / waste", "plastic bag complaint", "Shopping & Retail", 0.7),
    ("Sanitation / waste", "plastic bag complaint", "Food & Restaurants", 0.6),
    ("Infrastructure / streets", "street defect", "Local & Community Services", 0.6),
    ("Infrastructure / streets", "street defect", "Home Services", 0.4),
    ("Infrastructure / streets", "street light outage", "Local & Community Services", 0.7),
    ("Infrastructure / streets", "street light outage", "Home Services", 0.3),
    ("Infrastructure / streets", "alley light outage", "Local & Community Services", 0.7),
    ("Infrastructure / streets", "alley light outage", "Home Services", 0.3),
    ("Infrastructure / streets", "street paving", "Home Services", 0.5),
    ("Infrastructure / streets", "street paving", "Local & Community Services", 0.5),
    ("Infrastructure / streets", "dangerous sidewalk", "Local & Community Services", 0.6),
    ("Infrastructure / streets", "dangerous sidewalk", "Home Services", 0.4),
    ("Infrastructure / streets", "manhole cover", "Local & Community Services", 0.6),
    ("Infrastructure / streets", "manhole cover", "Home Services", 0.3),
    ("Infrastructure / streets", "right of way unit", "Local & Community Services", 0.6),
    ("Infrastructure / streets", "right of way unit", "Professional Services", 0.3),
    ("Infrastructure / streets", "shoveling", "Home Services", 0.7),
    ("Infrastructure / streets", "shoveling", "Local & Community Services", 0.4),
    ("Infrastructure / streets", "salting", "Home Services", 0.6),
    ("Infrastructure / streets", "salting", "Local & Community Services", 0.4),
    ("Infrastructure / streets", "hydrant request", "Local & Community Services", 0.6),
    ("Infrastructure / streets", "hydrant request", "Home Services", 0.3),
    ("Infrastructure / streets", "complaint (streets)", "Local & Community Services", 0.6),
    ("Infrastructure / streets", "complaint (streets)", "Home Services", 0.3),
    ("Infrastructure / streets", "other (streets)", "Local & Community Services", 0.5),
    ("Buildings / property", "maintenance complaint", "Home Services", 0.8),
    ("Buildings / property", "maintenance complaint", "Professional Services", 0.4),
    ("Buildings / property", "maintenance residential or commercial", "Home Services", 0.9),
    ("Buildings / property", "maintenance residential or commercial", "Professional Services", 0.5),
    ("Buildings / property", "dangerous building complaint", "Home Services", 0.7),
    ("Buildings / property", "dangerous building complaint", "Professional Services", 0.4),
    ("Buildings / property", "construction complaints", "Home Services", 0.8),
    ("Buildings / property", "construction complaints", "Professional Services", 0.5),
    ("Buildings / property", "graffiti removal", "Local & Community Services", 0.5),
    ("Buildings / property", "graffiti removal", "Entertainment & Arts", 0.4),
    ("Buildings / property", "graffiti removal", "Home Services", 0.4),
    ("Buildings / property", "smoke detector", "Home Services", 0.7),
    ("Buildings / property", "smoke detector", "Health & Medical", 0.3),
    ("Licensing / legal / safety", "license complaint", "Professional Services", 0.7),
    ("Licensing / legal / safety", "license complaint", "Food & Restaurants", 0.5),
    ("Licensing / legal / safety", "license complaint", "Shopping & Retail", 0.4),
    ("Licensing / legal / safety", "li escalation", "Professional Services", 0.6),
    ("Licensing / legal / safety", "li escalation", "Local & Community Services", 0.3),
    ("Licensing / legal / safety", "fire safety complaint", "Health & Medical", 0.5),
    ("Licensing / legal / safety", "fire safety complaint", "Local & Community Services", 0.5),
    ("Licensing / legal / safety", "police complaint", "Local & Community Services", 0.6),
    ("Licensing / legal / safety", "complaints against fire or ems", "Health & Medical", 0.6),
    ("Licensing / legal / safety", "complaints against fire or ems", "Local & Community Services", 0.4),
    ("Health / social services", "homeless encampment request", "Health & Medical", 0.5),
    ("Health / social services", "homeless encampment request", "Local & Community Services", 0.7),
    ("Health / social services", "opioid response unit", "Health & Medical", 0.9),
    ("Health / social services", "opioid response unit", "Local & Community Services", 0.3),
    ("Health / social services", "digital navigator request", "Education", 0.5),
    ("Health / social services", "digital navigator request", "Local & Community Services", 0.5),
    ("Health / social services", "eclipse help", "Local & Community Services", 0.5),
    ("Health / social services", "eclipse help", "Education", 0.4),
    ("Parks / environment", "street trees", "Active Life & Fitness", 0.5),
    ("Parks / environment", "street trees", "Local & Community Services", 0.5),
    ("Parks / environment", "street trees", "Home Services", 0.3),
    ("Parks / environment", "parks and rec safety and maintenance", "Active Life & Fitness", 0.9),
    ("Parks / environment", "parks and rec safety and maintenance", "Entertainment & Arts", 0.4),
    ("Parks / environment", "parks and rec safety and maintenance", "Local & Community Services", 0.3),
    ("General", "information request", "Local & Community Services", 0.5),
    ("General", "kb escalations", "Local & Community Services", 0.4),
    ("General", "miscellaneous", "Local & Community Services", 0.3),
)
