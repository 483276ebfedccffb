"""Parameters of the approval rules.

One JSON document may override the defaults; as in the source pipeline it replaces
them as a whole, so a missing key is an error rather than a silent fallback.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from decimal import Decimal

# The default approval configuration and the tier labels.
DEFAULT_CONFIG = {
    "premium_income_threshold": 100_000,
    "premium_rate": 0.15,
    "standard_rate": 0.08,
    "standard_floor": 2_000,
    "card_products": {
        "premium": "Infinite Sapphire",
        "standard": "Classic Rewards",
    },
}

PREMIUM = "PREMIUM"
STANDARD = "STANDARD"


@dataclass(frozen=True)
class ApprovalParams:
    threshold: int = DEFAULT_CONFIG["premium_income_threshold"]
    premium_rate: float = DEFAULT_CONFIG["premium_rate"]
    standard_rate: float = DEFAULT_CONFIG["standard_rate"]
    standard_floor: int = DEFAULT_CONFIG["standard_floor"]
    premium_product: str = DEFAULT_CONFIG["card_products"]["premium"]
    standard_product: str = DEFAULT_CONFIG["card_products"]["standard"]

    @classmethod
    def from_config(cls, cfg: dict) -> ApprovalParams:
        return cls(
            threshold=cfg["premium_income_threshold"],
            premium_rate=cfg["premium_rate"],
            standard_rate=cfg["standard_rate"],
            standard_floor=cfg["standard_floor"],
            premium_product=cfg["card_products"]["premium"],
            standard_product=cfg["card_products"]["standard"],
        )

    @classmethod
    def from_json(cls, text: str | None) -> ApprovalParams:
        """Defaults when ``text`` is None, else the document (all keys required)."""
        return cls() if text is None else cls.from_config(json.loads(text))

    def rate(self, which: str) -> Decimal:
        """Rates as exact decimals, so limits are computed without binary drift."""
        return Decimal(str(self.premium_rate if which == PREMIUM else self.standard_rate))
