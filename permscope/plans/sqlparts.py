"""DuckDB SQL fragments used by the oracle queries."""

from __future__ import annotations

from permscope.functions.names import RAW_NAME_KEYS


def high_perm(col: str = "ace_mask") -> str:
    m = f"lower(CAST({col} AS VARCHAR))"
    return (f"(({col} IS NOT NULL AND ({m} LIKE '%full%' OR {m} LIKE '%modify%' OR {m} LIKE '%write%'))"
            f" OR {mask_int(col)} <> 0)")


def name_from_raw(raw: str = "ace_raw") -> str:
    keys = []
    for k in RAW_NAME_KEYS:
        keys.append(f"NULLIF(json_extract_string({raw}, '$.\"{k}\"'), '')")
        if k.lower() != k:
            keys.append(f"NULLIF(json_extract_string({raw}, '$.\"{k.lower()}\"'), '')")
    probe = "COALESCE(" + ", ".join(keys) + ")"
    return (f"(CASE WHEN {raw} IS NULL OR {raw} = '' THEN '' "
            f"WHEN json_valid({raw}) AND json_type({raw}) = 'OBJECT' THEN COALESCE(TRIM({probe}), '') "
            f"WHEN json_valid({raw}) THEN '' ELSE TRIM({raw}) END)")


def res_name(name: str = "ace_name", raw: str = "ace_raw") -> str:
    return f"COALESCE(NULLIF(TRIM({name}), ''), {name_from_raw(raw)})"


def valid_folder(col: str = "folder_path") -> str:
    return f"({col} IS NOT NULL AND TRIM({col}) <> '' AND lower(TRIM({col})) <> 'nan')"


def contains_any(col: str, words) -> str:
    c = f"lower(COALESCE({col}, ''))"
    return "(" + " OR ".join(f"contains({c}, '{w.replace(chr(39), chr(39) * 2)}')" for w in words) + ")"


def is_full(col: str = "ace_mask") -> str:
    v = mask_int(col)
    return (f"(COALESCE(contains(lower({col}), 'full'), false) OR ({v} & 268435456) <> 0 "
            f"OR ({v} & 2032127) = 2032127)")


def normalized(src: str = "aces") -> str:
    """Rule-engine inputs: folder, res_name, sid, mask, inherited."""
    return (f"SELECT *, COALESCE(folder_path, '') AS folder, {res_name()} AS res_name, "
            f"COALESCE(ace_sid, '') AS sid, COALESCE(ace_mask, '') AS mask, "
            f"COALESCE(ace_inherited, false) AS inherited FROM {src}")


def mask_int(col: str = "ace_mask") -> str:
    # mask_to_int: decimal integers and 0x hex only (TRY_CAST alone would
    # also round decimals and read binary / underscores)
    t = f"trim(CAST({col} AS VARCHAR))"
    return (f"(CASE WHEN regexp_matches({t}, '^[+-]?[0-9]{{1,19}}$') OR regexp_matches({t}, '^0[xX][0-9a-fA-F]{{1,16}}$') "
            f"THEN COALESCE(TRY_CAST({t} AS BIGINT), 0) ELSE 0 END)")


def high_bitmask(col: str = "ace_mask") -> str:
    return (f"(COALESCE(regexp_matches(CAST({col} AS VARCHAR), '(?i)full|fullcontrol|modify|write'), false)"
            f" OR ({mask_int(col)} <> 0 AND ({mask_int(col)} & 3489660982) <> 0))")


def ps_name(name: str = "ace_name", sid: str = "ace_sid") -> str:
    return f"COALESCE(NULLIF(TRIM({name}), ''), NULLIF({sid}, ''), '')"
