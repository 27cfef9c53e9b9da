"""Session rules shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

DAY_SECS = 86400


@dataclass(frozen=True)
class SessionConfig:
    """What a session is.

    timeout_secs  a session breaks after this many seconds without a user action;
                  a gap of exactly this length still belongs to the session
    user_actions  event ids that are actions of a user, all others come from the product
    idle_cutoff   True: a product event later than the timeout gets no session;
                  False: the last session is carried forward without limit
    split_rows    a (user, product) pair with more events than this is worked on in time
                  slices by many tasks; the results are the same
    """

    timeout_secs: int = 300
    user_actions: tuple[str, ...] = ("a", "b", "c")
    idle_cutoff: bool = True
    split_rows: int = 500_000

    def __post_init__(self) -> None:
        if self.timeout_secs < 1:
            raise ValueError("timeout_secs must be at least 1")
        if not self.user_actions:
            raise ValueError("user_actions must not be empty")

    @property
    def slice_secs(self) -> int:
        """Width of a time slice: two user actions in one slice are always in one session."""
        return min(self.timeout_secs, DAY_SECS)

    @property
    def reach_days(self) -> int:
        """How many dates away from an event the timeout can reach."""
        return -(-self.timeout_secs // DAY_SECS)
