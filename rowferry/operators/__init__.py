"""DataFrame to DataFrame operators. None of them runs a job on data rows unless its docstring says so."""
