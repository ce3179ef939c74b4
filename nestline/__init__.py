"""nestline: recommendation audiences as composable Spark DataFrame operators."""

from nestline.config import CampaignConfig, NEW_LISTINGS, RECOMMENDED_HOMES

__all__ = ["CampaignConfig", "NEW_LISTINGS", "RECOMMENDED_HOMES"]
