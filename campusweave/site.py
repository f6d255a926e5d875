"""The one thing a run has to know about the site it reads."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Site:
    """Address and naming of the site whose pages are read.

    ``brand`` is the name under which the site publishes its own ranking and
    ``rank_label`` the wording put before such a rank.
    """

    base_url: str = "https://campus.example"
    brand: str = "Campus Guide"
    rank_label: str = "CG Rank"
    brand_aliases: tuple[str, ...] = ()

    def names(self) -> list[str]:
        return [self.brand.lower(), self.brand.lower() + ".com", *(a.lower() for a in self.brand_aliases)]


DEFAULT_SITE = Site()
