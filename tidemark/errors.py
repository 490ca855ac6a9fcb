"""Errors that the engine raises itself, before or while a plan runs."""


class ContractError(ValueError):
    """A request, schema or parameter breaks its contract; raised while a plan is built."""
