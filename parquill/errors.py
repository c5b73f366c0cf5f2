"""Errors that users see."""


class ParquillError(Exception):
    """Base of all errors of this package."""


class UnsupportedTypeError(ParquillError):
    def __init__(self, path: str, type_name: str):
        super().__init__(f"column {path}: type {type_name} is not supported; cast it to text in the query")
        self.path, self.type_name = path, type_name


class SettingsError(ParquillError):
    pass


class ConnectionProblem(ParquillError):
    pass
