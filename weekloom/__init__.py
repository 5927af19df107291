"""weekloom: weekly panel forecasting as ordinary Spark DataFrame operators."""

from weekloom.spec import PanelSpec

__all__ = ["PanelSpec"]
