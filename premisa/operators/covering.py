"""Sequential covering: grow, prune, accept, repeat.

The loop is shared by the three problem types; a *search* object supplies the distributed parts
(best candidate, pruning, bookkeeping of what is still uncovered).  All targets advance together, so one
job serves every class.  The driver holds conditions and a few counts, never rows.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from premisa.plans.params import InductionParams
from premisa.plans.rules import FIXED, Condition, add_condition

Premise = tuple[Condition, ...]


@dataclass(frozen=True)
class Step:
    """The best candidate of one growth step."""

    condition: Condition
    quality: float
    covered: float
    negatives: float
    new: float


@dataclass
class Listener:
    """Callbacks between jobs; override what is needed."""

    def on_new_rule(self, rule) -> None: ...

    def on_progress(self, total: float, uncovered: float) -> None: ...

    def should_stop(self) -> bool:
        return False


@dataclass
class Clock:
    growing: float = 0.0
    pruning: float = 0.0


@dataclass
class Covering:
    """State of one induction run."""

    search: object
    params: InductionParams
    listeners: Sequence[Listener] = ()
    rules: dict[str, list[Premise]] = field(default_factory=dict)
    clock: Clock = field(default_factory=Clock)
    stopped: bool = False

    def grow(
        self,
        start: Mapping[str, Premise],
        allow: Callable | None = None,
        limit: int | None = None,
    ) -> dict[str, Premise]:
        """Add the best condition to every premise until nothing qualifies or the limit is reached."""
        began = time.monotonic()
        limit = self.params.max_growing if limit is None else limit
        live, done = dict(start), {}
        history: dict[str, list[tuple[float, Premise]]] = {t: [] for t in live}
        quality: dict[str, float | None] = dict.fromkeys(live)
        while live:
            steps = self.search.best(live, allow)
            for t in list(live):
                step = steps.get(t)
                worse = (
                    step is not None
                    and self.search.must_improve
                    and quality[t] is not None
                    and step.quality <= quality[t]
                )
                if step is None or worse:
                    done[t] = live.pop(t)
                    continue
                live[t] = add_condition(live[t], step.condition)
                quality[t] = step.quality
                history[t].append((step.quality, live[t]))
                if step.negatives <= 0 or (limit and len(history[t]) >= limit):
                    done[t] = live.pop(t)
        if self.params.select_best_candidate:
            for t, seen in history.items():
                if seen:
                    done[t] = max(seen, key=lambda h: h[0])[1]
        self.clock.growing += time.monotonic() - began
        return done

    def prune(self, premises: Mapping[str, Premise]) -> dict[str, Premise]:
        """Hill climbing: drop the condition whose removal does not hurt the pruning measure."""
        if not self.params.enable_pruning:
            return dict(premises)
        began = time.monotonic()
        out = self.search.prune(premises)
        self.clock.pruning += time.monotonic() - began
        return out

    def accept(self, target: str, premise: Premise) -> float:
        """Take a rule in; returns how many uncovered examples it covers."""
        new = self.search.accept(target, premise)
        self.rules.setdefault(target, []).append(premise)
        for listener in self.listeners:
            listener.on_new_rule(self.search.describe(target, premise))
            listener.on_progress(self.search.total(), self.search.remaining())
            self.stopped = self.stopped or bool(listener.should_stop())
        return new

    def full(self, target: str) -> bool:
        """Whether a target needs no further rule."""
        limit = self.params.max_rule_count
        if limit and len(self.rules.get(target, [])) >= limit:
            return True
        return self.search.uncovered[target] <= self.params.max_uncovered_fraction * self.search.size[target]

    def run(self, targets: Sequence[str], start: Mapping[str, Premise] | None = None, allow=None) -> None:
        """Cover every target with rules grown from ``start`` (the empty premise by default)."""
        active = [t for t in targets if not self.full(t)]
        while active and not self.stopped:
            grown = self.grow({t: (start or {}).get(t, ()) for t in active}, allow)
            found = self.prune({t: p for t, p in grown.items() if p})
            again = []
            for t in active:
                premise = found.get(t)
                if not premise or premise in self.rules.get(t, []):
                    continue
                need = self.params.min_new(self.search.uncovered[t])
                if self.search.new_coverage(t, premise) < need:
                    continue
                self.accept(t, premise)
                if self.stopped:
                    return
                if not self.full(t):
                    again.append(t)
            active = again


def removable(premise: Premise) -> list[int]:
    """Positions pruning may drop: conditions an expert fixed stay."""
    return [i for i, c in enumerate(premise) if c.origin != FIXED]


def climb(premises: Mapping[str, Premise], qualities: Callable) -> dict[str, Premise]:
    """The hill climb itself.

    ``qualities`` maps a list of (target, kept positions) to a list of measure values; one call, hence at most one
    job, per round serves all targets.
    """
    kept = {t: tuple(range(len(p))) for t, p in premises.items()}
    live = {t for t, p in premises.items() if len(p) > 1 and removable(p)}
    current: dict[str, float | None] = {}
    while live:
        asks = [(t, kept[t]) for t in sorted(live) if t not in current]
        for t in sorted(live):
            free = set(removable(premises[t]))
            asks += [(t, tuple(k for k in kept[t] if k != i)) for i in kept[t] if i in free and len(kept[t]) > 1]
        values = dict(zip(asks, qualities(asks)))
        for t in sorted(live):
            now = values.pop((t, kept[t]), current.get(t))
            options = [(v, keep) for (tt, keep), v in values.items() if tt == t and v is not None and v == v]
            best = max(options, default=None, key=lambda o: (o[0], o[1]))
            if best is None or (now is not None and best[0] < now):
                live.discard(t)
                continue
            current[t], kept[t] = best
            if len(kept[t]) <= 1:
                live.discard(t)
    return {t: tuple(premises[t][i] for i in kept[t]) for t in premises}
