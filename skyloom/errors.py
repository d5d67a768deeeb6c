"""The one error of the engine."""


class LayoutError(RuntimeError):
    """Sources or tables lack the layout that safe row alignment needs."""
