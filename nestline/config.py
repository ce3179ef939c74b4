"""Campaign parameters and the fixed values that results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values. Inputs and outputs are only right when these match exactly.
# ---------------------------------------------------------------------------

# ids that stand for "no id"
PLACEHOLDER_IDS = ("unknown", "NULL", "null", "$CUSTOMER_ID_$", "$customer_id_$", "")

# values that stand for "no value" in click-stream columns
PLACEHOLDER_EVENT_VALUES = ("unknown", "UNKNOWN", "NULL", "null", "", " ")
PLACEHOLDER_EVENT_USERS = ("$CUSTOMER_ID_$", "$customer_id_$")

# listing types that may be recommended, compared in lower case
LISTING_TYPES = (
    "condo/townhome", "condo/townhome/row home/co-op", "condo/townhome/rowhome/coop",
    "condos", "coop", "duplex/triplex", "mfd/mobile home", "multi-family home",
    "single family home", "townhomes",
)

# states and territories that are served
STATES = (
    "AK", "AL", "AR", "AZ", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "GU", "HI", "IA", "ID",
    "IL", "IN", "KS", "KY", "LA", "MA", "MD", "ME", "MI", "MN", "MO", "MS", "MT", "NC", "ND",
    "NE", "NH", "NJ", "NM", "NV", "NY", "OH", "OK", "OR", "PA", "PR", "RI", "SC", "SD", "TN",
    "TX", "UT", "VA", "VI", "VT", "WA", "WI", "WV", "WY",
)

# event type -> (message version, notification type)
ENVELOPES = {
    "recommended_homes": ("1.0", "recommended_homes"),
    "recommended_homes_app": ("1.1", "recommended_homes_app_push-v1"),
    "recommended_homes_email": ("1.1", "recommended_homes_email-v1"),
    "new_listings": ("2.0", "recommended_homes"),
    "new_listings_app": ("2.1", "recommended_homes_app_push-v2"),
    "new_listings_email": ("2.1", "recommended_homes_email-v2"),
    "dom_zip_app": ("3.0", "recommended_homes_app_push-c"),
}

# columns of one recommendation inside a message, in message order
PUSH_FIELDS = (
    "listing_id", "property_id", "listing_address", "listing_status", "listing_photo_url",
    "listing_photo_count", "listing_square_feet", "listing_lot_square_feet", "ldp_url",
    "listing_city", "listing_state", "listing_postal_code", "listing_current_price",
    "listing_start_datetime_mst", "listing_number_of_bath_rooms",
    "listing_number_of_bed_rooms", "dom", "ldp_pageview_count", "shares_count", "saves_count",
    "viewed", "seq_id",
)
EMAIL_FIELDS = (
    "listing_id", "property_id", "email", "listing_address", "listing_status", "listing_type",
    "listing_photo_url", "listing_photo_count", "listing_square_feet",
    "listing_lot_square_feet", "ldp_url", "listing_city", "listing_state",
    "listing_postal_code", "listing_current_price", "listing_start_datetime_mst",
    "listing_number_of_bath_rooms", "listing_number_of_bed_rooms", "dom",
    "ldp_pageview_count", "saved_home", "shares_count", "saves_count", "viewed", "seq_id",
    "reccity", "recstate",
)

# suffix a resized photo gets in place of ".jpg"
RESIZED_PHOTO = "od-w640_h480_q80_r4.jpg"

EARTH_RADIUS_MILES = 3958.76
RATIO_FLOOR = 0.0002
MEMBER_ID_MAX_LENGTH = 24
FEATURE_ATTRIBUTES = ("price", "lot_sqft", "bath", "bed", "sqft")
FEATURE_WINDOWS = ("t90", "t90_20")

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CampaignConfig:
    """Everything that differs between campaigns; operators take values, not globals."""

    name: str
    variation: str
    top_zips: int
    std_factor: float
    listing_age_days: int
    user_groups: int
    median_age_days: int = 180
    min_median_price: float = 9999.0
    # windows of the daily jobs: events end the day before the run, the others with the run
    event_days: int = 90
    profile_days: int = 30
    feature_days: int = 31
    status: str = "for sale"
    states: tuple[str, ...] = STATES
    listing_types: tuple[str, ...] = LISTING_TYPES
    placeholder_ids: tuple[str, ...] = PLACEHOLDER_IDS
    metric_ranks: tuple[int, ...] = (1, 3, 12)
    max_per_state: int = 10
    ground_truth_days: int = 7
    # positions in a message; None sends each user one message with all of them
    recs_per_message: int | None = None


NEW_LISTINGS = CampaignConfig("new_listings", "V2", top_zips=3, std_factor=1.5,
                              listing_age_days=5, user_groups=50, event_days=5)
RECOMMENDED_HOMES = CampaignConfig("recommended_homes", "V1", top_zips=4, std_factor=3.0,
                                   listing_age_days=90, user_groups=12)
