from tallyhouse.sinks.counts import RunCounts
from tallyhouse.sinks.generations import Generations
from tallyhouse.sinks.replace import Replacement, replace_if_nonempty
from tallyhouse.sinks.stages import StageArea, sweep

__all__ = ["Generations", "Replacement", "RunCounts", "StageArea", "replace_if_nonempty", "sweep"]
