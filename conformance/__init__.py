"""Driver tables mapped to the staging and model shapes, with the same mapping in DuckDB SQL."""
