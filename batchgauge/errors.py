"""The two ways a batch can be refused."""


class ValidationError(Exception):
    """The batch has the wrong structure: no rows, or columns missing."""


class QualityError(Exception):
    """The scores exist but are not fit to be saved."""
