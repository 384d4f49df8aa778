"""Values a deployment may want to change."""

from __future__ import annotations

from dataclasses import dataclass

# Fixed value: the colour of a team without one.
DEFAULT_COLOUR = "#999999"

# Fixed value: one season spans this many entrant keys.
ENTRANT_KEY_STRIDE = 10_000


@dataclass(frozen=True)
class Assets:
    """Where pictures live and what stands in for a missing one."""

    default_photo: str = "assets/default_portrait.png"
    logo_base: str = "assets/teams/"
    default_colour: str = DEFAULT_COLOUR
