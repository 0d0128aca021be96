from .pipeline import Pipeline
from .stages import FUNCTIONS, Stage, WindowStage, register

__all__ = ["FUNCTIONS", "Pipeline", "Stage", "WindowStage", "register"]
