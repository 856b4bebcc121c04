"""Named pipeline steps."""

from __future__ import annotations

import inspect
from collections.abc import Callable


class StepRegistry:
    """Steps by the name a pipeline spec uses for them.

    A step takes a DataFrame first and returns one DataFrame, or a tuple of them.
    ``frames`` names further parameters that hold DataFrames; a spec gives the name
    of a frame there and the runner puts the frame in.
    """

    def __init__(self) -> None:
        self._steps: dict[str, Callable] = {}
        self._frame_parameters: dict[str, tuple[str, ...]] = {}

    def register(self, name: str | None = None, frames: tuple[str, ...] = ()) -> Callable:
        def keep(step: Callable) -> Callable:
            key = name or step.__name__
            if key in self._steps and self._steps[key] is not step:
                raise ValueError(f"step {key!r} is already registered")
            unknown = set(frames) - set(inspect.signature(step).parameters)
            if unknown:
                raise ValueError(f"step {key!r} has no parameters {sorted(unknown)}")
            self._steps[key] = step
            self._frame_parameters[key] = frames
            return step

        return keep

    def get(self, name: str) -> Callable:
        if name not in self._steps:
            raise ValueError(f"unknown step {name!r}; known steps: {', '.join(self.names())}")
        return self._steps[name]

    def frame_parameters(self, name: str) -> tuple[str, ...]:
        self.get(name)
        return self._frame_parameters[name]

    def names(self) -> list[str]:
        return sorted(self._steps)


STEPS = StepRegistry()
