"""Building blocks of the comparison SQL, written for DuckDB."""

from __future__ import annotations

from catalog_star import schemas as s
from catalog_star.registry.roles import AWARD_COLUMNS, LINE_ORDER, TRACK_COLUMNS

BLANKS = r"E' \t\n\r'"


def strip(x: str) -> str:
    return f"trim({x}, {BLANKS})"


def title(x: str) -> str:
    runs = rf"regexp_extract_all(lower({x}), '\p{{L}}+|\P{{L}}+')"
    word = "(case when w[1] = 'ß' then 'Ss' else upper(w[1]) end) || w[2:]"
    return f"array_to_string(list_transform({runs}, lambda w: {word}), '')"


def normalized(x: str) -> str:
    cut = rf"regexp_split_to_array(lower({strip(x)}), '\sfeat\.?|\swith\s|\s&\s|\(')[1]"
    return f"(case when {x} is null or {x} = 'N/A' then 'n/a' else {strip(cut)} end)"


def rounded(x: str, digits: int) -> str:
    return f"(round_even(({x}) * {10**digits}::double, 0) / {10**digits}::double)"


def coded(x: str, names: dict[int, str]) -> str:
    return f"case {x} " + " ".join(f"when {k} then '{v}'" for k, v in names.items()) + " end"


def _columns(columns: dict[str, str]) -> str:
    text = ", ".join(f"{sql} as {name}" for name, sql in columns.items())
    return text.replace("as string)", "as varchar)").replace("p_size / 50", "p_size / 50::double")


def _names(columns) -> str:
    return ", ".join(columns)


CTES: dict[str, str] = {
    "tracks_raw": f"""
        select row_ord, {_columns(TRACK_COLUMNS)}
        from (select *, row_number() over (order by {_names(LINE_ORDER)}) as row_ord from lineitem)
        join part on l_partkey = p_partkey
        join orders on l_orderkey = o_orderkey
        join customer on o_custkey = c_custkey""",
    "tracks_distinct": f"""
        select min(row_ord) as row_ord, {_names(TRACK_COLUMNS)}, count(*) as copies
        from tracks_raw group by {_names(TRACK_COLUMNS)}""",
    "tracks_clean": f"""
        select row_ord, {strip('track_id')} as track_id, replace({strip('artists')}, ';', ', ') as artists,
            {strip('album_name')} as album_name, {strip('track_name')} as track_name, popularity,
            coalesce(explicit, true) as explicit, {_names(s.AUDIO_FEATURES)},
            {coded('key', s.PITCH_NAMES)} as key, {coded('mode', s.MODE_NAMES)} as mode, time_signature,
            {strip('track_genre')} as track_genre,
            {rounded('duration_ms::double / 1000::double', 2)} as duration_s
        from tracks_distinct
        where track_id is not null and track_name is not null and artists is not null
            and album_name is not null and time_signature is distinct from 0""",
    "tracks_keyed": f"""
        select * exclude (explicit, track_genre), explicit as is_explicit,
            {title("replace(track_genre, '-', ' ')")} as track_genre,
            {strip("split_part(artists, ',', 1)")} as primary_artist,
            {normalized(strip("split_part(artists, ',', 1)"))} as primary_artist_normalized
        from tracks_clean""",
    "awards_raw": f"select {_columns(AWARD_COLUMNS)} from events",
    "awards_clean": rf"""
        select year, regexp_replace({title(strip('category'))}, '\s+', ' ', 'g') as category,
            coalesce({strip('nominee')}, 'N/A') as nominee, coalesce({strip('artist')}, 'N/A') as artist,
            coalesce({strip('workers')}, 'N/A') as workers, winner
        from awards_raw""",
    "award_summary": f"""
        select artist_normalized, count(winner) as grammy_wins, min(year) as grammy_first_year,
            max(year) as grammy_last_year,
            string_agg(distinct category, ' | ' order by category) as grammy_categories
        from (select *, {normalized('artist')} as artist_normalized from awards_clean)
        where artist_normalized <> 'n/a' group by artist_normalized""",
    "merged": """
        select t.*, a.grammy_wins is not null as grammy_winner, coalesce(a.grammy_wins, 0) as grammy_wins,
            coalesce(a.grammy_first_year, 0) as grammy_first_year,
            coalesce(a.grammy_last_year, 0) as grammy_last_year,
            coalesce(a.grammy_categories, 'N/A') as grammy_categories
        from tracks_keyed t left join award_summary a on t.primary_artist_normalized = a.artist_normalized""",
    "dim_artist": """
        select row_number() over (order by row_ord) as artist_key, primary_artist, grammy_winner, grammy_wins,
            nullif(grammy_first_year, 0) as grammy_first_year,
            nullif(grammy_last_year, 0) as grammy_last_year, grammy_categories
        from (select * from merged qualify row_number() over (partition by primary_artist order by row_ord) = 1)""",
    "dim_genre": """
        select row_number() over (order by first_ord) as genre_key, track_genre
        from (select track_genre, min(row_ord) as first_ord from merged group by track_genre)""",
    "keyed_track": """
        select row_number() over (order by row_ord) as track_key, *
        from (select * from merged qualify row_number() over (partition by track_id order by row_ord) = 1)""",
    "dim_track": """
        select track_key, track_name, album_name, is_explicit, duration_s, key as key_note, mode, time_signature
        from keyed_track""",
    "fact_streams": f"""
        select row_number() over (order by m.row_ord) as stream_key, t.track_key, a.artist_key, g.genre_key,
            m.popularity, {", ".join("m." + c for c in s.AUDIO_FEATURES)}
        from merged m left join keyed_track t on m.track_id is not distinct from t.track_id
            left join dim_artist a on m.primary_artist is not distinct from a.primary_artist
            left join dim_genre g on m.track_genre is not distinct from g.track_genre""",
}


def over(target: str, query: str) -> str:
    """``query`` preceded by the CTEs up to ``target``."""
    names = list(CTES)
    used = names[: names.index(target) + 1]
    # Joins of several facts read these more than once.
    heavy = {"merged", "dim_artist", "dim_genre", "keyed_track"}
    parts = [f"{n} as {'materialized ' if n in heavy else ''}({CTES[n]})" for n in used]
    return "with " + ",\n".join(parts) + "\n" + query
