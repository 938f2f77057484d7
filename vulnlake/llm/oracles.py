"""SQL equivalents of the corpus queries."""

# Every window of 400 bytes as hexadecimal text; bytes under a window that occurs twice are gaps between the kept parts.
REPEATS = """with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h from documents),
    -- long texts in overlapping parts, as a place in a text is found by walking to it
    b as (select r, i * 2000 as base, substr(h, cast(4000 * i + 1 as bigint), 4798) as x
          from (select r, h, unnest(range(cast(length(h) // 4000 + 1 as bigint))) as i from d) where length(h) >= 4000 * i + 800),
    w as (select r, base + q as p, md5(substr(x, cast(2 * q + 1 as bigint), 800)) as k
          from (select r, base, x, unnest(range(cast(length(x) // 2 - 399 as bigint))) as q from b)),
    c as (select r, p, p > lag(p) over (partition by r order by p) + 400 as cut
          from w where k in (select k from w group by k having count(*) > 1)),
    i as (select r, min(p) as s, max(p) + 400 as e
          from (select r, p, sum(coalesce(cut, false)::int) over (partition by r order by p) as island from c) group by r, island),
    g as (select r, s, e, coalesce(lag(e) over (partition by r order by s), 0) as before from i),
    k as (select r, count(*) as n_spans, sum(e - s) as n_removed, max(e) as last,
              string_agg(substr(h, cast(2 * before + 1 as bigint), cast(2 * (s - before) as bigint)), '' order by s) as head
          from g join d using (r) group by r)
    select doc_id, cast(length(h) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
        cast(coalesce(n_spans, 0) as bigint) as n_spans,
        sha256(unhex(coalesce(head, '') || substr(h, cast(2 * coalesce(last, 0) + 1 as bigint)))) as kept_sha256
    from d left join k using (r)"""

# Lines of every text as a list; the cuts fall between its elements.
FILL_IN_MIDDLE = r"""with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
    l as (select doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as u,
              [('0x' || substr(h, 1, 8))::bigint, ('0x' || substr(h, 9, 8))::bigint, ('0x' || substr(h, 17, 8))::bigint,
               ('0x' || substr(h, 25, 8))::bigint] as r from d),
    c as (select *, least(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) as a, greatest(r[1] % (len(u) + 1), r[2] % (len(u) + 1)) as b,
              t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r[3] % 100 >= 100 as plain from l),
    p as (select *, array_to_string(u[1:a], '') as p, array_to_string(u[a + 1:b], '') as m, array_to_string(u[b + 1:], '') as s from c),
    o as (select doc_id, len(u)::bigint as n, case when plain then 'plain' when r[4] % 100 < 50 then 'spm' else 'psm' end as form,
              p, m, s, t, plain, r from p)
    select doc_id, n, form, case when not plain then length(p)::bigint end as prefix_chars,
        case when not plain then length(m)::bigint end as middle_chars,
        sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
            else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
        sha256(case form when 'plain' then t else p || m || s end) as restored_sha256
    from o"""

# Sources in the order of size over weight are above the most they may have up to one place, which closes the shares at once.
MIX = r"""with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
    s as (select source, sum(size)::hugeint as source_size, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1]::hugeint as w
          from d group by source),
    o as (select *, row_number() over (order by source_size::double / w, source nulls last) as k,
              sum(source_size) over (order by source_size::double / w, source nulls last) as below,
              sum(w) over (order by source_size::double / w, source nulls last) as used,
              sum(source_size) over () as total, sum(w) over () as weights from s),
    h as (select coalesce(min(k), 0) as held from (
              select k, total - 3 * (below - source_size) as remain, weights - (used - w) as shares, w, source_size from o
              union all select max(k) + 1, 0, 1, 0, 0 from o)
          where w * remain <= 3 * source_size * shares),
    t as (select source, source_size, k < held as capped, w,
              (total - 3 * coalesce(sum(case when k < held then source_size end) over (), 0))::hugeint as remain,
              coalesce(sum(case when k >= held then w end) over (), 1)::hugeint as shares from o, h),
    r as (select source, source_size, case when capped then 3 * source_size else w * remain end as num, case when capped then 1 else shares end as den,
              ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8))::hugeint as draw from t),
    p as (select d.*, row_number() over (partition by source order by size, doc_id nulls last) as i from d),
    x as (select p.doc_id, p.source, p.size, r.source_size, num::double / den::double as target, i, num, den * r.source_size as divisor,
              (draw * den * r.source_size) // 4294967296 as first from p join r on p.source is not distinct from r.source)
    select doc_id, source, size, source_size::bigint as source_size, target, copies, (size * copies)::bigint as taken from (
    select doc_id, source, size, source_size, target, case when source_size = 0 then 0
            else (i * num + first) // divisor - ((i - 1) * num + first) // divisor end::bigint as copies from x)"""

# All repairs of a conversation up to its i-th row: per state of the result (0 nothing, 1 system, 2 user, 3 assistant) the cheapest edits,
# of these the ones that sort first. CRC-32 and the rows' order are spelled out.
CONVERSATIONS = r"""with recursive c as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        list_reduce(flatten([[4294967295::bigint],
            flatten(list_transform(range(length(k)), lambda i: [ascii(substr(k, i::bigint + 1, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))]),
            lambda a, b: case when b >= 0 then xor(a, b) else xor(a >> 1, 3988292384 * (a & 1)) end) as rest
        from (select *, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations)),
    d as (select conv_id, turn, case when code = 4 then 'user' else role end as role,
              case code when 1 then '' when 2 then replace(replace(replace(text, '.', ''), '!', ''), '?', '') else text end as text,
              unnest(range(case code when 0 then 0 when 3 then 2 else 1 end)) as copy
          from (select *, xor(rest, 4294967295) % 20 as code from c)),
    n as (select *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body,
              row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
              row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as again from d),
    f as (select *, case when body = '' then 'blank' when again > 1 then 'duplicate' when right(body, 1) not in ('.', '!', '?') then 'truncated'
              else '' end as fault, coalesce(substr(role, 1, 1), '') as initial,
              lag(substr(role, 1, 1)) over (partition by conv_id order by i) as before from n),
    ins(state, letters, cost, after) as (values (0, '', 0, 0), (1, '', 0, 1), (2, '', 0, 2), (3, '', 0, 3), (0, 'I', 5, 2), (1, 'I', 5, 2),
        (2, 'I', 5, 3), (3, 'I', 5, 2), (0, 'II', 10, 3), (1, 'II', 10, 3)),
    keep(state, initial, after) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
    rename(state, after) as (values (0, 2), (1, 2), (2, 3), (3, 2)),
    move as (select ins.state, e.initial, e.fault, ins.cost + e.cost as cost, ins.letters || e.letter as letters, e.after
             from ins join (
                 select s as state, null as initial, null as fault, 2 as cost, 'D' as letter, s as after from range(4) as r(s)
                 union all select state, initial, 'sound', 0, 'K', after from keep
                 union all select state, null, 'sound', 1, 'R', after from rename) e on ins.after = e.state),
    best as (select distinct conv_id, 0::bigint as i, 0 as state, 0::bigint as cost, '' as audit from f
             union all
             select conv_id, i, state, cost, audit from (
                 select b.conv_id, f.i, m.after as state, b.cost + m.cost + case when f.fault = 'truncated' and m.fault = 'sound' then 5 else 0 end as cost,
                     b.audit || m.letters as audit,
                     row_number() over (partition by b.conv_id, m.after order by
                         b.cost + m.cost + case when f.fault = 'truncated' and m.fault = 'sound' then 5 else 0 end, b.audit || m.letters) as place
                 from best b join f on b.conv_id is not distinct from f.conv_id and f.i = b.i + 1
                 join move m on m.state = b.state and (m.initial is null or m.initial = f.initial)
                     and (m.fault is null or f.fault in ('', 'truncated')))
             where place = 1),
    total as (select conv_id, count(*) as rows, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
                  count(*) filter (where fault = 'blank') as blank, count(*) filter (where fault = 'duplicate') as duplicate,
                  count(*) filter (where fault = 'truncated') as truncated,
                  count(*) filter (where i > 1 and before || initial not in ('su', 'ua', 'au')) as illegal from f group by conv_id),
    last as (select b.conv_id, b.cost + e.cost as cost, b.audit || e.letters as audit,
                 row_number() over (partition by b.conv_id order by b.cost + e.cost, b.audit || e.letters) as place
             from best b join total t on b.conv_id is not distinct from t.conv_id and b.i = t.rows
             join ins e on e.state = b.state and e.after in (0, 3)),
    letters as (select conv_id, cost, audit, unnest(range(1, length(audit) + 1)) as j from last where place = 1),
    edits as (select conv_id, j, substr(audit, j::bigint, 1) as letter,
                  count(*) filter (where substr(audit, j::bigint, 1) <> 'I') over (partition by conv_id order by j) as i,
                  count(*) filter (where substr(audit, j::bigint, 1) <> 'D') over (partition by conv_id order by j) as m,
                  count(*) filter (where substr(audit, j::bigint, 1) <> 'D') over (partition by conv_id) as turns from letters),
    said as (select e.conv_id, j, case when letter = 'K' then f.role when (m - turns % 2) % 2 = 1 then 'user' else 'assistant' end
                 || ':' || case when letter = 'I' then '' else f.text end as line
             from edits e left join f on e.conv_id is not distinct from f.conv_id and e.i = f.i where letter <> 'D'),
    whole as (select conv_id, string_agg(line, chr(10) order by j) as text from said group by conv_id)
    select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
        coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(l.cost, 0)::bigint as cost,
        coalesce(l.audit, '') as audit, sha256(coalesce(w.text, '')) as repaired_sha256
    from (select distinct conv_id from conversations) o left join total t on o.conv_id is not distinct from t.conv_id
    left join last l on o.conv_id is not distinct from l.conv_id and l.place = 1
    left join whole w on o.conv_id is not distinct from w.conv_id"""
