"""The SQL that each query must agree with, for DuckDB over the same tables."""

from __future__ import annotations

FILES = """
files as (
  select doc_id as seq, doc_id // 5 as batch_id, 'src/' || source || '/' || lang || '/' as path,
    'doc' || lpad(doc_id::varchar, 6, '0') || '.txt' as filename,
    octet_length(encode(text)) as size, encode(text) as content, sha256(text) as sha,
    case when doc_id % 23 = 0 then null when doc_id % 17 = 0 then sha256(text || 'x')
         else sha256(text) end as checksum,
    case when doc_id % 23 = 0 then 'missing' when doc_id % 17 = 0 then 'fail' else 'pass' end as state,
    source, lang
  from documents)"""

DEDUP = """
firsts as (
  select *, min(seq) over (partition by sha, size) as first_seq from files),
deduped as (
  select d.*, d.path || d.filename as filepath,
    case when d.size > 0 and d.seq <> d.first_seq then 'link' else 'file' end as kind,
    case when not (d.size > 0 and d.seq <> d.first_seq) then null
         when d.path = f.path then f.filename
         when d.source = f.source then '../' || f.lang || '/' || f.filename
         else '../../' || f.source || '/' || f.lang || '/' || f.filename end as target
  from firsts d join files f on f.seq = d.first_seq)"""

FRAGMENTS = """
fragments as (
  select seq, path, filename, size, (i + 1)::bigint as idx, n as cnt, i * 1000 as off,
    content[i * 1000 + 1 : (i + 1) * 1000] as part, sha as parent,
    (seq * 31 + i + 1) % 29 = 0 as lost
  from (select *, (size + 999) // 1000 as n from files where size > 1000), unnest(range(n)) u(i))"""

STORED = """
stored as (
  select * replace (case when seq % 31 = 0 then 0 else size end as size, case when seq % 31 = 0 then encode('') else content end as content),
    greatest(1, (case when seq % 31 = 0 then 0 else size end + 999) // 1000) as n from files)"""

ATTEMPTS = """
attempts as (
  select seq, path, filename, 'A' || seq as identifier, idx, cnt, idx as arrival from fragments
    where seq % 5 = 0 and idx <= cnt // 2
  union all
  select seq, path, filename, 'B' || seq, idx, cnt, cnt + idx from fragments
    where not (seq % 7 = 0 and idx = cnt)),
ordered as (
  select *, lag(identifier) over (partition by path, filename order by arrival) as prev from attempts),
numbered as (
  select *, sum(case when prev is null or prev <> identifier then 1 else 0 end)
    over (partition by path, filename order by arrival) as run from ordered),
current_run as (
  select * from (select *, max(run) over (partition by path, filename) as last_run from numbered)
  where run = last_run)"""

FRAMES = """
frames as (
  select seq as id, seq::varchar as uuid, size, i * 466 as off, 466::bigint as mtu, pass::bigint as pass,
    12100 + seq % 4 as port, i as slot, (size - 1) // 466 + 1 as total,
    (((seq // 8) * 2 + pass - 1) * 8 + seq % 8) * 100000 + i as arrival,
    content[i * 466 + 1 : (i + 1) * 466] as payload
  from (select * from files where size > 0), unnest(range((size - 1) // 466 + 1)) u(i),
    (values (1), (2)) p(pass)
  where not ((seq * 7 + i * 13 + pass * 5) % 11 = 0 or (seq + i) % 37 = 0)),
frame_state as (
  select uuid, id, total, count(distinct slot) as seen, count(*) - count(distinct slot) as dups
  from frames group by uuid, id, total)"""

RUNS = """
frame_order as (
  select *, lag(uuid) over (partition by port order by arrival) as prev from frames),
frame_runs as (
  select *, max(case when prev is null or prev <> uuid then arrival end)
    over (partition by port order by arrival) as run_start from frame_order),
run_state as (
  select port, uuid, run_start, total, count(distinct slot) as seen,
    count(*) - count(distinct slot) as dups
  from frame_runs group by port, uuid, run_start, total),
run_result as (
  select *, case when seen = total then 'complete'
    when run_start < max(run_start) over (partition by port) then 'abandoned'
    else 'incomplete' end as state
  from run_state)"""

PACKETS = """
packets as (
  select * from (
    select conv_id::varchar as socket_id, (turn + 1)::bigint as n,
      case when turn = max(turn) over (partition by conv_id) then 'EOF' else '' end as op, text,
      md5(conv_id::varchar || '/' || turn::varchar) as arrival, (conv_id + turn + 1) % 11 = 0 as lost
    from conversations) where not lost),
packet_firsts as (
  select socket_id, n, min(arrival) as first_arrival, row_number() over (partition by socket_id order by n) as rank
  from packets group by socket_id, n),
prefix as (
  select socket_id, n, max(first_arrival) over (partition by socket_id order by n) as released_at
  from packet_firsts where n = rank),
copies as (
  select p.*, x.released_at,
    row_number() over (partition by p.socket_id, p.n order by p.arrival desc) as newest
  from packets p join prefix x on p.socket_id = x.socket_id and p.n = x.n and p.arrival <= x.released_at),
released as (
  select * from (
    select *, min(case when op = 'EOF' then n end) over (partition by socket_id) as last_n
    from copies where newest = 1)
  where last_n is null or n <= last_n)"""

HOPS = """
hops as (
  select event_id // 4 as uuid, 3 - event_id % 4 as hop, event_type as action,
    'host' || user_id % 10 as host, epoch_us(ts) * 1000 as ts_ns, ts, (value * 100)::bigint as size
  from events)"""

REPORT = """
report as (
  select epoch(time_bucket(interval 5 minute, ts))::bigint as period_start, host, action,
    count(*) as files, sum(size)::bigint as bytes,
    count(*) filter (uuid % 2 = 1) as forwarded_files
  from hops group by 1, 2, 3)"""

# A path is cleaned by folding its elements into the text of the result.
CLEAN_MACRO = """
list_reduce(string_split({path}, '/'), lambda acc, part:
  case when part in ('', '.') then acc
       when part = '..' and {rooted} then regexp_replace(acc, '/?[^/]*$', '')
       when part = '..' and (acc = '' or acc = '..' or acc like '%/..')
         then case when acc = '' then '..' else acc || '/..' end
       when part = '..' then regexp_replace(acc, '/?[^/]*$', '')
       when acc = '' then part
       else acc || '/' || part end, '')"""


def clean_sql(path: str) -> str:
    rooted = f"({path}) like '/%'"
    folded = CLEAN_MACRO.format(path=path, rooted=rooted)
    return f"(case when {rooted} then '/' || {folded} when {folded} = '' then '.' else {folded} end)"


ODD_PATH = """case seq % 9 when 0 then path when 1 then 'a/../' || lang || '//' when 2 then '../' || source
  when 3 then '..' || source when 4 then '/' || source || '/../' || lang
  when 5 then source || '/../../' || lang when 6 then '' when 7 then '/../' || source || '/./'
  else source || '/' || lang || '/../b/' end"""

ODD_KIND = """case seq % 7 when 0 then '' when 1 then 'file' when 2 then 'dir' when 3 then 'link'
  when 4 then 'metrics' when 5 then 'pipe' end"""

ROUTE = """case when coalesce(kind, '') in ('', 'file') then 'file'
  when kind in ('dir', 'link', 'metrics') then kind else 'reject' end"""

ODD_TARGET = """case seq % 5 when 0 then '../' || lang when 1 then '../../../../' || lang
  when 2 then '/etc/' || source when 3 then '' else 'x/./y/../' || filename end"""

STAMP = "2024-01-01T00:00:00.000000001Z"


def _with(*views: str) -> str:
    return "with " + ",".join(views) + "\n"


def _chain(shift: int) -> str:
    """The pairs of a flow's map, its hop numbers raised by `shift`."""
    fields = (
        ("action", "action"),
        ("local.hostname", "host"),
        ("time", "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"),
    )
    return "\nunion all\n".join(
        f"select uuid, 'custodyChain.' || (hop + {shift}) || '.{name}' as name, {value} as value from hops"
        for name, value in fields
    )


def _stamped(fields: dict[str, str]) -> str:
    return "".join(
        f"\nunion all\nselect distinct uuid, '{name}', {value} from hops" for name, value in fields.items()
    )


def _gate(strict: bool) -> str:
    bad = "state <> 'pass'" if strict else "state = 'fail'"
    return f"max(({bad})::int) over (partition by batch_id) = 0"


SPACE = r"[\t\n\v\f\r\x{85}\p{Z}]+"


def trim_sql(text: str) -> str:
    return f"regexp_replace({text}, '^{SPACE}|{SPACE}$', '', 'g')"


ORACLES: dict[str, str] = {
    "source_report": _with(FILES, DEDUP)
    + """select source, count(*) as files, count(*) filter (state = 'pass') as n_pass,
      count(*) filter (state = 'fail') as n_fail, count(*) filter (state = 'missing') as n_missing,
      count(*) filter (kind = 'link') as links,
      coalesce(sum(size) filter (kind = 'link'), 0)::bigint as bytes_saved
    from deduped group by source""",
    "scan_files": _with(FILES, STORED)
    + """select path || filename as filepath, 'file' as kind, size, (i + 1)::bigint as idx, n::bigint as cnt,
      (i * 1000)::bigint as "offset", sha256(content[i * 1000 + 1 : (i + 1) * 1000]) as sha256
    from stored, unnest(range(n)) u(i)""",
    "scan_fragments": _with(FILES, STORED)
    + """select filename, n::bigint as cnt, size, 'unverified' as state, size > 5000 as large, sha256(content) as sha256
    from stored where n > 1""",
    "store_fragments": _with(FILES, FRAGMENTS)
    + """select filename, state, got as size, case when state = 'complete' then parent end as sha256 from (
      select filename, max(parent) as parent, sum(octet_length(part))::bigint as got,
        case when count(*) < max(cnt) then 'incomplete' when seq % 13 = 0 then 'corrupt' else 'complete' end as state
      from fragments where not lost group by seq, filename)""",
    "frame_faults": _with(FILES, FRAMES)
    + """select case when id % 13 = 0 then 'short' else 'mtu' end as fault, count(*) as frames
    from frames where id % 13 = 0 or id % 19 = 0 group by 1""",
    "read_static_attrs": f"""
    with lines as (
      select page_id, i as pos, {trim_sql("string_split(html, chr(10))[i + 1]")} as line
      from pages, unnest(range(len(string_split(html, chr(10))))) u(i)),
    pairs as (
      select page_id, pos, line, strpos(line, ':') as colon from lines where strpos(line, ':') > 0)
    select page_id, pos, {trim_sql("left(line, colon - 1)")} as name,
      {trim_sql("substr(line, colon + 1)")} as value
    from pairs where not starts_with(line, '#')""",
    "stage_feed": _with(FILES)
    + f"""select batch_id, 'TO-DISK' as action, count(*) as files, sum(size)::bigint as bytes,
      sum(size)::bigint as attr_bytes
    from (select *, {_gate(True)} as ok from files) where ok group by batch_id""",
    "committed_batches": _with(FILES)
    + "select seq, batch_id, size from files where batch_id % 3 <> 0",
    "replay_feed": _with(FILES)
    + f"""select seq, case when batch_id % 50 <> 0 then batch_id end as batch_id, size, 'FROM-DISK' as action,
      'TO-DISK' as earlier_action, 'h2' as host, sha as sha256
    from (select *, case when batch_id % 50 = 0 then state = 'pass' else {_gate(True)} end as ok from files) where ok""",
    "stage_stream": _with(FILES)
    + f"""select batch_id, 'TO-DISK' as action, count(*) as files, sum(size)::bigint as bytes
    from (select *, {_gate(True)} as ok from files) where ok group by batch_id""",
    "audit_feed": _with(FILES)
    + "select state, count(*) as files, sum(size)::bigint as bytes from files group by state",
    "forward_feed": _with(FILES)
    + f"""select seq, '192.0.2.1:7' || case when seq % 2 = 0 then ',10.0.0.' || seq else '' end as forwarded_for,
      'RELAY' as action, case when ok then 'out' else 'reject' end as result
    from (select *, {_gate(False)} as ok from files where seq % 41 <> 0)
    union all
    select seq, case when seq % 2 = 0 then '10.0.0.' || seq else '' end, '', 'metrics'
    from files where seq % 41 = 0""",
    "outgoing_feed": _with(FILES, DEDUP)
    + """select seq, kind, target,
      case when kind = 'link' then 0 when size > 1000 then least(1000, size - i * 1000) else size end::bigint as size,
      (i + 1)::bigint as idx, n::bigint as cnt, 'SENDER' as action,
      case when kind = 'file' then sha256(content[i * 1000 + 1 : (i + 1) * 1000]) end as checksum
    from (select *, case when kind = 'file' and size > 1000 then (size + 999) // 1000 else 1 end as n
          from deduped), unnest(range(n)) u(i)""",
    "incoming_feed": _with(
        FILES,
        f"odd as (select * replace ({ODD_PATH} as path), {ODD_KIND} as kind, {ODD_TARGET} as target from files)",
        f"cleaned as (select *, {ROUTE} as route, {clean_sql('path')} as clean_path from odd)",
        "pointed as (select *, case when target = '' then clean_path else clean_path || '/' || target end as aim from cleaned)",
        f"resolved as (select *, {clean_sql('aim')} as resolved from pointed)",
    )
    + """select seq, route, clean_path, case when route = 'link' then 'unchecked' else state end as state,
      case when clean_path like '..%' or route = 'reject' then 'rejected'
           when route = 'metrics' then 'metered'
           when route = 'link' and (target = '' or target like '/%' or resolved like '..%') then 'dropped'
           when route = 'file' and state <> 'pass' then 'rejected'
           else 'stored' end as outcome
    from resolved""",
    "synth_feed": """select doc_id as seq, './' as path, 'file' || case when doc_id < 10000
        then lpad(doc_id::varchar, 4, '0') else doc_id::varchar end || '.dat' as filename,
      n_chars % 5000 as size, case when n_chars % 5000 > 0 then 'SHA1' end as checksum_type,
      case when n_chars % 5000 > 0 then sha1(repeat('\\x00'::blob, n_chars % 5000)) end as checksum,
      n_chars % 5000 as content_size, 'FLOOD' as action
    from documents""",
    "attach_static_attrs": _with(FILES)
    + """select seq as uuid, 'source' as name, source as value from files
    union all
    select seq, name, value from files, (
      select case when r_regionkey = 4 then 'area0' else 'area' || r_regionkey end as name, r_name as value
      from region where r_regionkey > 0)""",
    "shift_chain": _with(HOPS) + _chain(1) + _stamped({"custodyChain.0.time": f"'{STAMP}'"}),
    "stamp_hop": _with(HOPS)
    + _chain(1)
    + _stamped(
        {
            "custodyChain.0.time": f"'{STAMP}'",
            "custodyChain.0.action": "'RELAY'",
            "custodyChain.0.local.hostname": "'h1'",
            "custodyChain.0.request.uri": "'/in'",
            "custodyChain.0.source.host": "'s' || uuid % 7",
            "custodyChain.0.source.port": "'4000'",
            "custodyChain.0.protocol": "'HTTP'",
            "custodyChain.0.local.port": "'8080'",
            "team": "'a'",
        }
    )
    + "\nunion all\nselect distinct uuid, 'custodyChain.0.local.host', '::1' from hops where uuid % 3 <> 0",
    "explode_hops": _with(HOPS) + "select uuid, hop, action, host as hostname, ts_ns from hops",
    "append_forwarded_for": """select page_id, '10.1.' || page_id % 5 ||
      case when page_id % 3 = 1 and url <> '' then ',' || url else '' end as forwarded_for from pages""",
    "add_checksum": _with(FILES)
    + """select seq, case when checksum is not null then 'SHA256' when size > 0 then 'SHA1' end as kept_type,
      case when checksum is not null then checksum when size > 0 then sha1(content) end as kept,
      sha as sha256, sha1(content) as sha1, md5(content) as md5 from files""",
    "verify_checksum": _with(
        FILES,
        """judged as (select seq, case when state = 'missing' then 'missing' when seq % 29 = 0 then 'unsupported'
          else state end as state from files)""",
    )
    + """select seq, state, state = 'pass' as stage_ok, state in ('pass', 'missing') as relay_ok,
      true as audit_ok from judged""",
    "path_guard": _with(FILES, f"odd as (select seq, {ODD_PATH} as path from files)")
    + f"""select seq, path, {clean_sql('path')} as clean_path, {clean_sql('path')} not like '..%' as path_ok
    from odd""",
    "link_guard": _with(
        FILES,
        f"odd as (select seq, path, {ODD_TARGET} as target from files)",
        f"resolved as (select *, {clean_sql('path || target')} as resolved from odd)",
    )
    + """select seq, target, resolved,
      target <> '' and target not like '/%' and resolved not like '..%' as link_ok from resolved""",
    "route_by_kind": _with(FILES, f"odd as (select *, {ODD_KIND} as kind from files)")
    + f"select {ROUTE} as route, count(*) as files, sum(size)::bigint as bytes from odd group by 1",
    "parse_frames": _with(FILES, FRAMES)
    + """select id as seq, pass, h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32] as uuid,
      size, off as "offset", mtu, sha256(payload) as payload_sha
    from (select *, md5(uuid) as h from frames) where id % 13 <> 0 and id % 19 <> 0""",
    "canonical_attrs": _with(FILES)
    + """select seq as uuid, 'lang' as name, lang as value from files
    union all
    select seq, 'checksumType', case when seq % 2 = 0 then 'NEW' else 'OLD' end from files
    union all
    select seq, 'file.lastModifiedTime', source from files where seq % 2 = 1""",
    "attrs_json": _with(HOPS) + _chain(0),
    "numbered_packets": """select socket_id, n, socket_id <> '' and n not like 'x%' as accepted from (
      select case when conv_id % 9 = 0 then '' else conv_id::varchar end as socket_id,
        case when turn % 5 = 4 then 'x' || turn else (turn + 1)::varchar end as n from conversations)""",
    "resolve_links": _with(FILES, DEDUP)
    + """select d.seq, case when d.seq % 10 = 0 then d.path || 'gone.txt' else f.path || f.filename end as resolved,
      case when d.seq % 10 = 0 then 'dangling' else 'resolved' end as link_state,
      case when d.seq % 10 <> 0 then f.size end as resolved_size,
      case when d.seq % 10 <> 0 then f.sha end as resolved_checksum
    from deduped d join files f on f.seq = d.first_seq where d.kind = 'link'""",
    "missing_fragments": _with(FILES, FRAGMENTS)
    + """select seq::varchar as identifier, idx from fragments
    where lost and cnt > 1 and seq in (select seq from fragments where not lost)""",
    "fragment_status": _with(FILES, FRAGMENTS)
    + """select seq::varchar as identifier, count(distinct idx) as seen, max(cnt) as cnt,
      case when count(distinct idx) = max(cnt) then 'complete' else 'incomplete' end as state
    from fragments where not lost and cnt > 1 group by seq""",
    "reassemble": _with(FILES, FRAGMENTS)
    + """select seq::varchar as identifier, max(cnt) as cnt, max(size) as size, 'complete' as state,
      max(parent) as sha256
    from fragments where not lost group by seq having count(distinct idx) = max(cnt)""",
    "frame_status": _with(FILES, FRAMES)
    + """select uuid, total, seen, dups, case when seen = total then 'complete' else 'incomplete' end as state
    from frame_state""",
    "reassemble_frames": _with(FILES, FRAMES)
    + """select uuid, size, 'complete' as assembly, state, state = 'pass' as accepted, sha as sha256
    from frame_state join files on seq = id where seen = total""",
    "batch_gate": _with(FILES)
    + f"select seq, batch_id, state, {_gate(True)} as batch_ok from files",
    "size_histogram": _with(HOPS)
    + """select host, action, case when size < 10 then 0 else length(size::varchar) - 1 end::bigint as bucket,
      count(*) as n from hops group by 1, 2, 3""",
    "feed_metrics": _with(HOPS, REPORT) + "select period_start, host, action, files, bytes from report",
    "custody_paths": _with(HOPS)
    + """select path, count(*) as files from (
      select uuid, string_agg(action, '>' order by hop desc) as path from hops group by uuid)
    group by path""",
    "dedup_savings": _with(FILES, DEDUP)
    + """select source, count(*) as files, count(*) filter (kind = 'link') as links,
      coalesce(sum(size) filter (kind = 'link'), 0)::bigint as bytes_saved from deduped group by source""",
    "dedup_to_links": _with(FILES, DEDUP)
    + """select seq, filepath, kind, target, case when kind = 'link' then 0 else size end as size,
      size as orig_size, sha as checksum from deduped""",
    "hop_latency": _with(
        HOPS,
        """pairs as (select lag(action) over w as from_action, action as to_action, ts_ns - lag(ts_ns) over w as elapsed
          from hops window w as (partition by uuid order by hop desc))""",
    )
    + """select from_action, to_action, count(*) as n, sum(elapsed)::bigint as sum,
      sum(elapsed)::double / count(*)::double as avg,
      floor(quantile_cont(elapsed, 0.5) + 0.5)::bigint as p50,
      floor(quantile_cont(elapsed, 0.95) + 0.5)::bigint as p95, max(elapsed) as max
    from pairs where elapsed is not null group by 1, 2""",
    "latest_attempt": _with(FILES, FRAGMENTS, ATTEMPTS)
    + """select path, filename, identifier, count(distinct idx) as seen, max(cnt) as cnt,
      case when count(distinct idx) = max(cnt) then 'complete' else 'incomplete' end as state
    from current_run group by 1, 2, 3""",
    "run_status": _with(FILES, FRAMES, RUNS)
    + "select port, uuid, run_start, total, seen, dups, state from run_result",
    "inflight_runs": _with(FILES, FRAMES, RUNS)
    + """select port, uuid, run_start, run_start < max(run_start) over (partition by port) as followed,
      total, seen, dups, state, frames, bytes
    from run_result join (
      select port, uuid, run_start, count(*) as frames, sum(octet_length(payload))::bigint as bytes
      from frame_runs group by port, uuid, run_start) using (port, uuid, run_start)""",
    "bitmap_gaps": _with(FILES, FRAGMENTS)
    + """select identifier, min(idx) as from_n, max(idx) as to_n from (
      select seq::varchar as identifier, idx, idx - row_number() over (partition by seq order by idx) as island
      from fragments where lost and cnt > 1 and seq in (select seq from fragments where not lost))
    group by identifier, island""",
    "on_complete": _with(FILES)
    + "select batch_id, count(*) as files, sum(size)::bigint as bytes from files group by batch_id",
    "sequence_release": _with(PACKETS)
    + "select socket_id, n, op, arrival, released_at, sha256(text) as sha256 from released",
    "sequence_gaps": _with(PACKETS)
    + """select socket_id, prev + 1 as from_n, n - 1 as to_n from (
      select socket_id, n, coalesce(lag(n) over (partition by socket_id order by n), 0) as prev
      from (select distinct socket_id, n from packets)) where n - prev > 1""",
    "walk_order": """
    select arg_pos, filepath, size,
      row_number() over (order by arg_pos, string_split(filepath, '/')) - 1 as seq
    from (select doc_id % 2 as arg_pos, octet_length(encode(text)) as size,
        'src/' || source || case when doc_id % 3 = 0 then '-b/' else '/' end
          || 'doc' || lpad(doc_id::varchar, 6, '0') || '.txt' as filepath from documents)""",
    "merge_metrics": _with(HOPS, REPORT)
    + "select period_start, host, action, files, bytes, forwarded_files from report",
    "segment": _with(FILES)
    + """select seq, case when n > 1 then i + 1 end::bigint as idx, case when n > 1 then n end::bigint as cnt,
      case when n > 1 then i * 1000 end::bigint as off,
      octet_length(content[i * 1000 + 1 : (i + 1) * 1000])::bigint as size,
      sha256(content[i * 1000 + 1 : (i + 1) * 1000]) as checksum,
      case when n > 1 then size end as orig_size, case when n > 1 then sha end as orig_checksum
    from (select *, case when size > 1000 then (size + 999) // 1000 else 1 end as n from files),
      unnest(range(n)) u(i)""",
    "stream_fragments": _with(
        FILES,
        FRAGMENTS,
        ATTEMPTS.replace("attempts as (", "sent as (", 1).replace(
            "ordered as (",
            "attempts as (select * from sent where (seq + idx) % 40 <> 0),\nordered as (",
            1,
        ),
        """told as (
      select path, filename, identifier, run, count(distinct idx) as seen, max(cnt) as cnt from numbered group by all),
    ends as (select path, filename, max(arrival) as latest from attempts group by all)""",
    )
    + """select path, filename, identifier, 'completed' as event, seen, cnt from told where seen = cnt
    union all
    select path, filename, identifier, 'expired', seen, cnt
    from (select *, max(run) over (partition by path, filename) as last_run from told) join ends using (path, filename)
    where run = last_run and seen < cnt and latest + 5 <= (select max(arrival) from attempts)
    union all
    select path, filename, identifier, 'rejected', null, cnt from sent where (seq + idx) % 40 = 0""",
    "stream_frames": _with(FILES, FRAMES, RUNS)
    + """select port, uuid, case when state = 'complete' then 'completed' else state end as event, total, seen
    from run_result where state <> 'incomplete'""",
    "stream_sequence": _with(PACKETS) + "select socket_id, n, 'released' as event, arrival from released",
    "stream_dedup": _with(FILES, DEDUP) + "select seq, filepath, kind, target from deduped",
    "stream_metrics": _with(HOPS, REPORT)
    + """select period_start, host, action, files, bytes from report
    where period_start + 300 <= (select floor(epoch_ms(max(ts)) / 1000.0) - 60 from hops)""",
}
ORACLES["bitmap_status"] = ORACLES["fragment_status"]
ORACLES["relay_stream"] = ORACLES["forward_feed"]
ORACLES["custody_paths_from_attrs"] = ORACLES["custody_paths"]
ORACLES["hop_latency_from_attrs"] = ORACLES["hop_latency"]
