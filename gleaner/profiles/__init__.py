"""Source profiles: everything site-specific, as data, or as a function that reads a page."""

from gleaner.profiles.model import CardSpec, ItemSpec, KeyedStateSpec, LinkedDataSpec, SourceProfile, StateTreeSpec
from gleaner.profiles.catalog import PROFILES, profile
from gleaner.profiles.registry import all_profiles, forget_profile, register_profile

__all__ = [
    "PROFILES", "CardSpec", "ItemSpec", "KeyedStateSpec", "LinkedDataSpec", "SourceProfile",
    "StateTreeSpec", "all_profiles", "forget_profile", "profile", "register_profile",
]
