"""Oracle SQL (DuckDB dialect) for the registered queries.

Each string rebuilds the bindings from the driver's tables with plain SQL
and computes the operator independently: the vote oracles unpivot the bins
to rows and count agreements, while the Spark side runs the one-scan or join
form.
"""

from __future__ import annotations

from ..schema import BIN_COLS, N_BINS
from ..sources.bindings import BIN_MOD_BASE, LINE_STRIDE, query_bins_a
from ..functions.minhash import MINHASH_PRIME, TOKEN_HEX_DIGITS, minhash_coefficients
from . import registry as RG

_BIN_EXPRS = ",\n".join(f"cast(o_orderkey % {BIN_MOD_BASE + i} as int) as {c}" for i, c in enumerate(BIN_COLS))

TRACKS = """tracks as (
  select cast(c_custkey as int) as Id,
         case when c_custkey % 10 = 0 then null when c_custkey % 10 = 1 then ''
              else concat('ISRC', cast(c_custkey % 500 as varchar)) end as ISRC,
         c_mktsegment as Artist, c_name as Title,
         concat('album-', cast(c_nationkey as varchar)) as Album,
         cast(1950 + c_nationkey as int) as ReleaseYear,
         abs(c_acctbal) as Length
  from customer)"""

SLICES = f"""slices as (
  select o_orderkey as Id, cast(o_custkey as int) as TrackId,
         cast(row_number() over w - 1 as int) as SequenceNumber,
         cast((row_number() over w - 1) * 0.928 as double) as SequenceAt,
         {_BIN_EXPRS},
         case when o_orderkey % 7 = 0 then '' when o_orderkey % 11 = 0 then null
              else concat(lower(o_orderpriority), ',', o_orderstatus) end as Clusters
  from orders
  window w as (partition by o_custkey order by o_orderdate, o_orderkey))"""

SIGNATURES = """signatures as (
  select cast(c_custkey as int) as Id, unhex(md5(c_name)) as Signature, cast(c_custkey as int) as TrackId
  from customer)"""

BINS_LONG = f"""bins_long as (
  select cast(p + 1 as int) as HashTable, cast(o_orderkey % ({BIN_MOD_BASE} + p) as bigint) as HashBin,
         o_orderkey as SubFingerprintId
  from orders, range({N_BINS}) t(p))"""


def _minhash_select(id_expr: str, src: str) -> str:
    aggs = ",\n".join(
        f"cast(min((x * {a} + {b}) % {MINHASH_PRIME}) as int) as {c}"
        for (a, b), c in zip(minhash_coefficients(), BIN_COLS)
    )
    return f"""select {id_expr} as Id, {aggs}
  from (select _owner, cast(('0x' || substr(md5(w), 1, {TOKEN_HEX_DIGITS})) as bigint) % {MINHASH_PRIME} as x
        from (select {src}) where w <> '')
  group by _owner"""


DOC_SLICES = "doc_slices as (" + _minhash_select("_owner", "doc_id as _owner, unnest(string_split(text, ' ')) as w from documents") + ")"
QUERY_DOCS = "query_docs as (" + _minhash_select("_owner", "item_id as _owner, unnest(string_split(text, ' ')) as w from benchmark") + ")"

LINE_SLICES = f"""doc_lines as (
  select doc_id as _doc, lang, source, unnest(range(len(parts))) as line_no, unnest(parts) as line
  from (select doc_id, lang, source, string_split(text, chr(10)) as parts from documents where text is not null)),
line_bins as ({_minhash_select("_owner", f"_doc * {LINE_STRIDE} + line_no as _owner, unnest(string_split(line, ' ')) as w from doc_lines")}),
line_slices as (
  select b.Id, cast(l._doc as int) as TrackId, cast(l.line_no as int) as SequenceNumber,
         cast(l.line_no as double) as SequenceAt, {", ".join("b." + c for c in BIN_COLS)},
         concat(l.lang, ',', l.source) as Clusters
  from line_bins b join doc_lines l on b.Id = l._doc * {LINE_STRIDE} + l.line_no),
bench_lines as (
  select item_id as set_id, unnest(range(len(parts))) as line_no, unnest(parts) as line
  from (select item_id, string_split(text, chr(10)) as parts from benchmark where text is not null)),
query_bins as ({_minhash_select("_owner", f"set_id * {LINE_STRIDE} + line_no as _owner, unnest(string_split(line, ' ')) as w from bench_lines")}),
query_lines as (
  select q.Id as qid, l.set_id, {", ".join("q." + c for c in BIN_COLS)}
  from query_bins q join bench_lines l on q.Id = l.set_id * {LINE_STRIDE} + l.line_no)"""


def _with(*ctes: str) -> str:
    return "with " + ",\n".join(ctes) + "\n"


def _agreeing(table: str, bins: list[int]) -> str:
    """One row for each position in which a row of ``table`` has the query's
    bin: rows are unpivoted and compared with the query as a list."""
    return f"""select Id from (
    select Id, p + 1 as pos, list_extract([{", ".join(BIN_COLS)}], p + 1) as bin from {table}, range({N_BINS}) t(p)
  ) e where bin = list_extract({bins}, pos)"""


def _voted(table: str, bins: list[int], t: int) -> str:
    return f"""voted as (
  select Id, count(*) as votes from ({_agreeing(table, bins)}) h group by Id having count(*) >= {t})"""


def _pair_votes(a: str, b: str) -> str:
    return " + ".join(f"cast({a}.{c} = {b}.{c} as int)" for c in BIN_COLS)


def _exploded(table: str, idcol: str, name: str, extra: str = "") -> str:
    cols = ", ".join(f"{c}" for c in BIN_COLS)
    return f"""{name} as (
  select {idcol} as _id{extra}, p as pos, list_extract([{cols}], p + 1) as bin
  from {table}, range({N_BINS}) t(p))"""


QK = RG.QUERY_KEY
QB = query_bins_a(QK)
T = RG.THRESHOLD
TB = RG.BATCH_THRESHOLD
TI = RG.IDENTIFY_THRESHOLD
ALL_SLICE = "Id, TrackId, SequenceNumber, SequenceAt, " + ", ".join(BIN_COLS) + ", Clusters"
BINS_TEXT = "concat_ws(',', " + ", ".join(f"cast({c} as varchar)" for c in BIN_COLS) + ")"

ORACLE: dict[str, str] = {
    "read_tracks": _with(TRACKS) + "select * from tracks",
    "insert_tracks": _with(TRACKS)
    + """select cast((select max(Id) from tracks) + row_number() over (order by s_suppkey) as int) as Id,
       concat('SUP', cast(s_suppkey as varchar)) as ISRC, 'supplier' as Artist, s_name as Title,
       concat('album-', cast(s_nationkey as varchar)) as Album, cast(1950 + s_nationkey as int) as ReleaseYear,
       abs(s_acctbal) as Length
from supplier""",
    "insert_hashes": _with(DOC_SLICES)
    + f"""select cast((select max(o_orderkey) from orders) + row_number() over (order by d.Id) as bigint) as Id,
       cast(d.Id as int) as TrackId, 0 as SequenceNumber, cast(0.0 as double) as SequenceAt,
       {", ".join("d." + c for c in BIN_COLS)}, concat_ws(',', m.lang, m.source) as Clusters
from doc_slices d join documents m on d.Id = m.doc_id""",
    "insert_signatures": """select cast((select max(c_custkey) from customer) + row_number() over (order by c_custkey) as int) as Id,
       lower(hex(unhex(md5(concat(c_name, '#2'))))) as Signature_hex, cast(c_custkey as int) as TrackId
from customer""",
    "append_bins_routed": _with(BINS_LONG) + "select * from bins_long",
    "append_bins_twice": _with(BINS_LONG) + "select * from bins_long",
    "track_by_id": _with(TRACKS) + f"select * from tracks where Id = {RG.LOOKUP_TRACK}",
    "tracks_by_ids": _with(TRACKS)
    + "select p.p_partkey as ordinal, cast(p.p_partkey as int) as RequestedId, t.* from part p left join tracks t on t.Id = cast(p.p_partkey as int)",
    "tracks_by_ids_repeated": _with(TRACKS)
    + "select o.o_orderkey as ordinal, cast(o.o_custkey as int) as RequestedId, t.Id, t.Title from orders o left join tracks t on t.Id = cast(o.o_custkey as int)",
    "tracks_by_artist_title": _with(TRACKS) + f"select * from tracks where Artist = '{RG.GROUP}' and Title = 'Customer#000000000'",
    "track_by_isrc": _with(TRACKS) + "select * from tracks where ISRC = 'ISRC7' order by Id limit 1",
    "first_track_per_isrc": _with(TRACKS)
    + "select * from tracks t where ISRC is not null and Id = (select min(Id) from tracks u where u.ISRC = t.ISRC)",
    "hashes_by_track": _with(SLICES)
    + f"""select Id, {BINS_TEXT} as bins, SequenceNumber, cast(cast(SequenceAt as float) as double) as StartsAt,
       case when Clusters is null or Clusters = '' then 0 else len(string_split(Clusters, ',')) end as n_clusters,
       case when Clusters is null or Clusters = '' then '' else array_to_string(string_split(Clusters, ','), '|') end as clusters
from slices where TrackId = {RG.TRACK}""",
    "slice_by_id": _with(SLICES) + f"select * from slices where Id = {QK}",
    "signatures_by_track": _with(SIGNATURES)
    + f"select Id, lower(hex(Signature)) as Signature_hex, TrackId from signatures where TrackId = {RG.SIGNATURE}",
    "posting_list": _with(SLICES) + f"select Id from slices where {BIN_COLS[RG.POSTING_POSITION]} = {RG.POSTING_BIN}",
    "pack_bins": _with(SLICES) + f"select Id, {BINS_TEXT} as bins from slices",
    "spread_bins": _with(SLICES) + "select Id, " + ", ".join(BIN_COLS) + " from slices",
    "encode_clusters": _with(SLICES) + "select Id, coalesce(Clusters, '') as Clusters from slices",
    "decode_clusters": _with(SLICES)
    + """select Id,
       case when Clusters is null or Clusters = '' then 0 else len(string_split(Clusters, ',')) end as n_labels,
       case when Clusters is null or Clusters = '' then '' else array_to_string(string_split(Clusters, ','), '|') end as labels
from slices""",
    "candidates_join_back": _with(SLICES)
    + f"select * from slices where Id in (\n  {_agreeing('slices', QB)}\n)",
    "track_by_signature_id": _with(TRACKS, SIGNATURES)
    + f"select t.* from tracks t join signatures s on t.Id = s.TrackId where s.Id = {RG.SIGNATURE}",
    "backfill_track_id": _with(BINS_LONG, SLICES)
    + "select b.HashTable, b.HashBin, b.SubFingerprintId, s.TrackId from bins_long b left join slices s on b.SubFingerprintId = s.Id",
    "vote_lookup": _with(SLICES, _voted("slices", QB, T)) + f"select {ALL_SLICE} from slices where Id in (select Id from voted)",
    "vote_lookup_clusters": _with(SLICES, _voted("slices", QB, T))
    + f"select {ALL_SLICE} from slices where Id in (select Id from voted) and Clusters like '%{','.join(RG.CLUSTER_LABELS)}%'",
    "vote_lookup_clusters_like": _with(SLICES, _voted("slices", QB, T))
    + f"select {ALL_SLICE} from slices where Id in (select Id from voted) and regexp_matches(Clusters, '[1-3]-[^lu].*,[FO]')",
    "vote_lookup_clusters_lcase": _with(SLICES, _voted("slices", QB, T))
    + f"select {ALL_SLICE} from slices where Id in (select Id from voted) and lower(Clusters) like '%{','.join(RG.CLUSTER_LABELS)}%'",
    "stream_then_lookup": _with(SLICES, _voted("slices", QB, T))
    + f"select TrackId, SequenceNumber, cast(cast(SequenceAt as float) as double) as SequenceAt, {BINS_TEXT} as bins from slices where Id in (select Id from voted)",
    "store_delete_then_insert": _with(
        TRACKS, SLICES, "gone as (select cast(c_custkey as int) as Id from customer where c_acctbal < 0)",
        """held as (select TrackId, count(*) as n from slices where TrackId not in (select Id from gone)
    or TrackId in (select Id from gone where Id % 2 = 0) and SequenceNumber < 3 group by TrackId)""",
    )
    + f"""select t.Id, coalesce(n, 0) as n_slices, coalesce(n, 0) as n_ids, {N_BINS} * coalesce(n, 0) as n_bins,
  (select count(*) from slices where TrackId in (select Id from gone)) as slices_removed
from tracks t left join held on TrackId = t.Id where t.Id not in (select Id from gone where Id % 2 <> 0)""",
    "store_evolved": _with(TRACKS)
    + """select Id, ISRC as Code, Artist, Title, cast(ReleaseYear as bigint) as ReleaseYear, cast(null as varchar) as GroupId from tracks
union all select cast(s_suppkey + 10000000 as int), concat('SUP', cast(s_suppkey as varchar)), 'supplier', s_name, cast(1950 + s_nationkey as bigint), 'new' from supplier""",
    "vote_lookup_votes": _with(SLICES, _voted("slices", QB, T))
    + "select s.Id, s.TrackId, cast(v.votes as int) as votes from slices s join voted v on s.Id = v.Id",
    "vote_lookup_group": _with(SLICES, TRACKS, _voted("slices", QB, T))
    + f"select s.* from slices s where s.Id in (select Id from voted) and s.TrackId in (select Id from tracks where Artist = '{RG.GROUP}')",
    "vote_lookup_group_lcase": _with(SLICES, TRACKS, _voted("slices", QB, T))
    + f"select s.* from slices s where s.Id in (select Id from voted) and s.TrackId in (select Id from tracks where lower(Artist) = '{RG.GROUP.lower()}')",
    "vote_lookup_inverted": _with(BINS_LONG)
    + "select SubFingerprintId as Id, count(*) as votes from (\n  "
    + "\n  union all\n  ".join(
        f"select SubFingerprintId from bins_long where HashTable = {i + 1} and HashBin = {b}" for i, b in enumerate(QB)
    )
    + f"\n) h group by SubFingerprintId having count(*) >= {T}",
    "vote_lookup_t0": _with(SLICES, _voted("slices", QB, 0)) + "select Id, cast(votes as int) as votes from voted",
    "vote_lookup_t25": _with(SLICES, _voted("slices", QB, 25)) + f"select {ALL_SLICE} from slices where Id in (select Id from voted)",
    "vote_lookup_clusters_any": _with(SLICES, _voted("slices", QB, T))
    + f"""select {ALL_SLICE} from slices where Id in (select Id from voted)
and Clusters is not null and Clusters <> '' and list_has_any(string_split(Clusters, ','), ['F', '1-urgent'])""",
    "vote_lookup_inverted_batch": _with(DOC_SLICES, QUERY_DOCS, _exploded("doc_slices", "Id", "se"), _exploded("query_docs", "Id", "qe"))
    + f"""select qe._id as qid, se._id as Id, cast(count(*) as int) as votes
from qe join se on qe.pos = se.pos and qe.bin = se.bin
group by qe._id, se._id having count(*) >= {TB}""",
    "union_posting_lists": _with(SLICES)
    + "\n  union all\n  ".join(
        f"select Id, {i} as position from slices where {c} = {b}" for i, (c, b) in enumerate(zip(BIN_COLS, QB))
    ),
    "vote_lookup_batch": _with(DOC_SLICES, QUERY_DOCS)
    + f"""select s.Id, {BINS_TEXT.replace("cast(", "cast(s.")} as bins from doc_slices s
where s.Id in (select s2.Id from doc_slices s2, query_docs q where {_pair_votes('q', 's2')} >= {TB})""",
    "vote_lookup_batch_votes": _with(DOC_SLICES, QUERY_DOCS, _exploded("doc_slices", "Id", "se"), _exploded("query_docs", "Id", "qe"))
    + f"""select qe._id as qid, se._id as Id, cast(count(*) as int) as votes
from qe join se on qe.pos = se.pos and qe.bin = se.bin
group by qe._id, se._id having count(*) >= {TB}""",
    "vote_lookup_batch_clusters": _with(LINE_SLICES, _exploded("line_slices", "Id", "se", ", TrackId, SequenceNumber, Clusters"), _exploded("query_lines", "qid", "qe"))
    + f"""select distinct se._id as Id, se.TrackId, se.SequenceNumber from (
  select qe._id as q, se._id as s from qe join se on qe.pos = se.pos and qe.bin = se.bin
  group by qe._id, se._id having count(*) >= {TI}) p
join se on se._id = p.s where se.Clusters like '%en,%'""",
    "similar_pairs": _with(DOC_SLICES, _exploded("doc_slices", "Id", "e"))
    + f"""select a._id as a_id, b._id as b_id, cast(count(*) as int) as votes
from e a join e b on a.pos = b.pos and a.bin = b.bin and a._id < b._id
group by a._id, b._id having count(*) >= {TB}""",
    "identify_tracks": _with(LINE_SLICES, _exploded("line_slices", "Id", "se", ", TrackId"), _exploded("query_lines", "qid", "qe", ", set_id"))
    + f""", pairs as (
  select qe.set_id, qe._id as qid, se._id as sid, se.TrackId, count(*) as votes
  from qe join se on qe.pos = se.pos and qe.bin = se.bin
  group by qe.set_id, qe._id, se._id, se.TrackId having count(*) >= {TI}),
entries as (
  select set_id, TrackId, count(distinct qid) as matched_queries, count(*) as matched_slices,
         cast(sum(votes) as bigint) as total_votes
  from pairs group by set_id, TrackId),
ranked as (
  select *, row_number() over (partition by set_id order by matched_queries desc, total_votes desc, TrackId) as rn
  from entries)
select set_id, TrackId, matched_queries, matched_slices, total_votes, rn = 1 as is_best from ranked""",
    "identify_best": _with(LINE_SLICES, _exploded("line_slices", "Id", "se", ", TrackId"), _exploded("query_lines", "qid", "qe", ", set_id"))
    + f""", pairs as (
  select qe.set_id, qe._id as qid, se._id as sid, se.TrackId, count(*) as votes
  from qe join se on qe.pos = se.pos and qe.bin = se.bin
  group by qe.set_id, qe._id, se._id, se.TrackId having count(*) >= {TI}),
entries as (
  select set_id, TrackId, count(distinct qid) as matched_queries, count(*) as matched_slices,
         cast(sum(votes) as bigint) as total_votes
  from pairs group by set_id, TrackId),
ranked as (
  select *, row_number() over (partition by set_id order by matched_queries desc, total_votes desc, TrackId) as rn
  from entries)
select set_id, TrackId, matched_queries, matched_slices, total_votes from ranked where rn = 1""",
    "minhash_bins": _with(DOC_SLICES) + "select Id as doc_id, " + ", ".join(BIN_COLS) + " from doc_slices",
    "bins_to_long": _with(BINS_LONG) + "select * from bins_long",
    "bins_to_wide": _with(SLICES) + f"select {ALL_SLICE} from slices",
    "bins_to_wide_track": _with(SLICES) + f"select {ALL_SLICE} from slices where TrackId = {RG.TRACK}",
    "split_bins_by_table": _with(BINS_LONG) + "select * from bins_long",
    "rebase_bins": _with(BINS_LONG)
    + "select cast(HashTable - 1 as int) as HashTable, cast(HashBin as int) as HashBin, SubFingerprintId from bins_long",
    "denormalise_albums": _with(TRACKS)
    + """select t.Id, t.ISRC, t.Artist, t.Title,
       case when n.n_nationkey is not null then n.n_name else t.Album end as Album,
       case when n.n_nationkey is not null then cast(1950 + n.n_regionkey as int) else t.ReleaseYear end as ReleaseYear,
       t.Length, cast(c.c_nationkey as int) as AlbumId
from tracks t join customer c on t.Id = cast(c.c_custkey as int)
left join nation n on cast(c.c_nationkey as int) = n.n_nationkey""",
    "evolve_schema": _with(TRACKS)
    + "select Id, ISRC as Isrc, Artist, Title, Album, cast(ReleaseYear as bigint) as ReleaseYear, cast(null as varchar) as GroupId from tracks",
    "evolve_schema_twice": _with(TRACKS)
    + "select Id, ISRC as Isrc, Artist, Title, Album, cast(ReleaseYear as bigint) as ReleaseYear, cast(null as varchar) as GroupId from tracks",
    "backfill_repeated_key": """select c_custkey as Id, p.o_orderpriority as Priority, p.o_orderstatus as Status
from customer left join (
  select o_custkey, o_orderpriority, o_orderstatus from orders
  qualify row_number() over (partition by o_custkey order by o_orderpriority, o_orderstatus) = 1
) p on c_custkey = o_custkey""",
    "delete_track": _with(TRACKS, SLICES, SIGNATURES)
    + f"""select 'tracks' as "table", count(*) as removed from tracks where Id = {RG.TRACK}
union all select 'slices', count(*) from slices where TrackId = {RG.TRACK}
union all select 'signatures', count(*) from signatures where TrackId = {RG.TRACK}
union all select 'total', (select count(*) from tracks where Id = {RG.TRACK}) + (select count(*) from slices where TrackId = {RG.TRACK})
  + (select count(*) from signatures where TrackId = {RG.TRACK})""",
    "delete_tracks": _with(TRACKS, SLICES, SIGNATURES, "gone as (select cast(c_custkey as int) as Id from customer where c_acctbal < 0)")
    + """, c as (
  select 'tracks' as "table", count(*) as removed from tracks where Id in (select Id from gone)
  union all select 'slices', count(*) from slices where TrackId in (select Id from gone)
  union all select 'signatures', count(*) from signatures where TrackId in (select Id from gone))
select * from c union all select 'total', cast(sum(removed) as bigint) from c""",
    "delete_tracks_remaining": _with(SLICES, "gone as (select cast(c_custkey as int) as Id from customer where c_acctbal < 0)")
    + "select Id, TrackId from slices where TrackId not in (select Id from gone)",
    "delete_bins_by_track": _with(BINS_LONG, SLICES)
    + f"select * from bins_long where SubFingerprintId not in (select Id from slices where TrackId = {RG.TRACK})",
    "delete_cascade": _with(TRACKS, SLICES, SIGNATURES, BINS_LONG, "gone as (select cast(c_custkey as int) as Id from customer where c_acctbal < 0)")
    + """, c as (
  select 'tracks' as "table", count(*) as removed from tracks where Id in (select Id from gone)
  union all select 'slices', count(*) from slices where TrackId in (select Id from gone)
  union all select 'signatures', count(*) from signatures where TrackId in (select Id from gone)
  union all select 'bins_long', count(*) from bins_long where SubFingerprintId in (select Id from slices where TrackId in (select Id from gone)))
select * from c union all select 'total', cast(sum(removed) as bigint) from c""",
    "check_ranges": _with(TRACKS.replace("abs(c_acctbal) as Length", "c_acctbal as Length"))
    + """select *, case when coalesce(not (ReleaseYear > -1), false) and coalesce(not (Length > -1), false) then 'ReleaseYear,Length'
                 when coalesce(not (ReleaseYear > -1), false) then 'ReleaseYear' else 'Length' end as rule
from tracks where coalesce(not (ReleaseYear > -1), false) or coalesce(not (Length > -1), false)""",
    "check_orphans": _with(SLICES)
    + """select Id, TrackId, 'foreign key TrackId' as rule from slices
where TrackId is not null and TrackId not in (select cast(c_custkey as int) from customer where c_acctbal >= 0)""",
    "check_unique": _with(TRACKS) + "select ISRC, count(*) as n, 'unique ISRC' as rule from tracks group by ISRC having count(*) > 1",
    "check_required": _with(TRACKS)
    + """select *, concat('not null ', concat_ws(',', case when ISRC is null then 'ISRC' end, case when Artist is null then 'Artist' end,
       case when Title is null then 'Title' end)) as rule
from tracks where ISRC is null or Artist is null or Title is null""",
    "check_unique_bins": _with(BINS_LONG)
    + """select HashTable, HashBin, SubFingerprintId, count(*) as n, 'unique HashTable,HashBin,SubFingerprintId' as rule
from bins_long group by 1, 2, 3 having count(*) > 1""",
    "check_unique_ids": _with(SLICES) + "select Id, count(*) as n, 'unique Id' as rule from slices group by Id having count(*) > 1",
    "check_required_bins": _with(SLICES)
    + f"select Id, 'not null' as rule from slices where {' or '.join(c + ' is null' for c in ['TrackId', 'SequenceNumber', 'SequenceAt', *BIN_COLS])}",
    "check_lengths_tracks": _with(TRACKS)
    + f"""select Id, concat('too long ', concat_ws(',', case when length(ISRC) > {RG.LENGTH_LIMITS['tracks']['ISRC']} then 'ISRC' end,
       case when length(Artist) > 255 then 'Artist' end, case when length(Title) > 255 then 'Title' end,
       case when length(Album) > {RG.ALBUM_LIMIT} then 'Album' end)) as rule
from tracks where length(ISRC) > 50 or length(Artist) > 255 or length(Title) > 255 or length(Album) > {RG.ALBUM_LIMIT}""",
    "check_lengths": "select doc_id, length(text) as n_chars, 'too long text' as rule from documents where length(text) > 255",
    "fit_lengths": "select doc_id, substr(text, 1, 255) as text from documents",
    "check_isrc_not_empty": _with(TRACKS) + "select *, 'ISRC not empty' as rule from tracks where ISRC = ''",
    "flatten_record": """select c_custkey as key, c_custkey as Customer_c_custkey, c_name as Customer_c_name,
       c_nationkey as Customer_c_nationkey, c_mktsegment as Customer_c_mktsegment from customer""",
    "default_nulls": _with(TRACKS)
    + """select Id, coalesce(ISRC, '') as ISRC, coalesce(Artist, '') as Artist, coalesce(Title, '') as Title,
       coalesce(Album, '') as Album, coalesce(ReleaseYear, 0) as ReleaseYear, coalesce(Length, 0.0) as Length from tracks""",
    "enum_from_name": f"select event_id, case when event_type is null then '{RG.EVENT_TYPES[0]}' "
    + " ".join(f"when lower(event_type) = '{m.lower()}' then '{m}'" for m in RG.EVENT_TYPES)
    + " end as event_type from events",
    "enum_from_ordinal": "select l_orderkey, l_linenumber, case coalesce(l_linenumber, 0) "
    + " ".join(f"when {k} then '{v}'" for k, v in sorted(RG.LINE_NAMES.items()))
    + " else cast(coalesce(l_linenumber, 0) as varchar) end as line_name from lineitem",
    "nest_record": "select * from customer",
    "to_unique_map": """select n_regionkey, count(*) as n,
       string_agg(cast(n_nationkey as varchar) || '=' || n_name, ',' order by n_nationkey) as map
from nation group by n_regionkey""",
    "first_or_none": "select o_orderkey, o_custkey, o_totalprice from orders order by o_orderdate, o_orderkey limit 1",
}
