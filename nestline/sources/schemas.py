"""Schemas of inputs that do not carry their own."""

from __future__ import annotations

# Fixed names of the sources' fields; only those that are read, so that nothing else is parsed.
REAL_PROFILE = """
    user_id string,
    zip_stats array<struct<category_name: string, score: string>>,
    price_stats struct<overall_mean: string, overall_std_dev: string>,
    target_date string
"""

RECOMMENDATIONS = """
    user_id string,
    recommendations array<struct<mpr_id: string, listing_id: string>>,
    state string
"""

OPT_INS = "userId string, optIns struct<app: boolean, web: boolean>"

DOMINANT_ZIPS = """
    member_id string, ldp_dominant_zip string, listing_state string, run_date_yyyymmdd string
"""

PUSH_SENT = """
    external_user_id string, campaign_id string, canvas_id string,
    year string, month string, day string
"""

EMAIL_SENT = """
    customer_id string, campaign_id string, email string,
    year string, month string, day string
"""

CITY_LOOKUP_CONSUMER = """
    consumer_ip_city string, ldp_city string, con_pct_web_uls_median string, web_uus_sum string
"""
CITY_LOOKUP_LISTING = """
    consumer_ip_city string, ldp_city string, ldp_pct_web_uls_median string, web_uus_sum string
"""
ZIP_LOOKUP_CONSUMER = """
    consumer_ip_zip string, ldp_zip string, con_pct_web_uls_median string, web_uus_sum string
"""
ZIP_LOOKUP_LISTING = """
    consumer_ip_zip string, ldp_zip string, ldp_pct_web_uls_median string, web_uus_sum string
"""
