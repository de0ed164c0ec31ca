"""Training-data operators: quality, de-duplication, privacy, mixing, packing, formatting.

Each module holds one operator with a general interface; ``queries`` registers
the contract queries and their DuckDB SQL.  Nothing outside this
package imports it.
"""
