"""All parameters of a run in one frozen object; the defaults are the fixed values."""

from __future__ import annotations

from dataclasses import dataclass

from tenderloom import fixed_values as fv


@dataclass(frozen=True)
class Settings:
    cpv_prefix: str = fv.CPV_PREFIX
    cpv_excluded: tuple[str, ...] = fv.CPV_EXCLUDED_PREFIXES
    cpv_general: str = fv.CPV_GENERAL_PREFIX
    keywords_positive: tuple[str, ...] = fv.KEYWORDS_POSITIVE
    keywords_negative: tuple[str, ...] = fv.KEYWORDS_NEGATIVE
    nuts_allowed: tuple[str, ...] = fv.NUTS_ALLOWED
    keep_missing_nuts: bool = True
    min_value: float = fv.MIN_VALUE
    keep_missing_value: bool = True
    center: tuple[float, float] = (fv.CENTER_LAT, fv.CENTER_LON)
    radius_km: float = fv.RADIUS_KM
    keep_unknown_location: bool = True
    # key, lat, lon, buyer, buyer id, profile URL, agency?
    profiles: tuple[tuple, ...] = fv.BUYER_PROFILES
    changes_kept: int = fv.CHANGES_KEPT
    changes_max_age_days: int = fv.CHANGES_MAX_AGE_DAYS
    competition_window_days: int = fv.COMPETITION_WINDOW_DAYS
    contract_days_before: int = fv.CONTRACT_DAYS_BEFORE
    contract_days_after: int = fv.CONTRACT_DAYS_AFTER
    price_tolerance: float = fv.PRICE_TOLERANCE
    # a buyer and supplier with more contract versions than this are searched by price
    paired_contracts: int = 1000
    max_amendments: int = fv.MAX_AMENDMENTS
    max_verdicts: int = fv.MAX_VERDICTS_PER_RUN
    verdict_batch: int = fv.VERDICT_BATCH
    max_details: int = fv.MAX_DETAILS_PER_RUN
    max_documents: int = fv.MAX_DOCUMENTS_PER_RUN
    min_result_ratio: float = fv.MIN_RESULT_RATIO

    @property
    def agency_sources(self) -> list[str]:
        return [fv.PROFILE_PREFIX + p[0] for p in self.profiles if p[6]]
