"""DuckDB SQL of queries with an optimal assignment: every assignment of a group is listed by a recursive query, and the best one kept."""

from __future__ import annotations

from .evaluations import ell_inter, ell_sql
from .fixtures import DT, GT, IMG, TD, inter_sql, iou_sql
from .queries import ORACLE

#: From pr (k, g, d, v > 0) the pairs best (k, g, d, v) of each group k that use every g and d once and have the greatest sum of v.
BEST = """gs as (select k, g, row_number() over (partition by k order by g) r from (select distinct k, g from pr)),
op as (select k, g, d, v from pr union all select k, g, null, 0.0::double from gs),
w as (select k, 0::bigint r, []::bigint[] u, []::struct(g bigint, d bigint, v double)[] s, 0.0::double t from (select distinct k from pr)
  union all select w.k, w.r+1, case when op.d is null then w.u else list_append(w.u, op.d) end,
    case when op.d is null then w.s else list_append(w.s, {'g': op.g, 'd': op.d, 'v': op.v}::struct(g bigint, d bigint, v double)) end, w.t+op.v
  from w join gs on gs.k=w.k and gs.r=w.r+1 join op on op.k=gs.k and op.g=gs.g where op.d is null or not list_contains(w.u, op.d)),
best as (select k, unnest(s, recursive := true) from (select k, arg_max(s, t) s from w join (select k kk, max(r) n from gs group by 1) on kk=k and n=r group by k))"""

ORACLE["optimal_matches"] = f"""with recursive {GT}, {DT},
pr as (select g.image_id*10+g.class_id k, g.ann_id::bigint g, d.det_id::bigint d, {iou_sql('g', 'd')} v from gt g join dt d using (image_id, class_id) where {iou_sql('g', 'd')} > 0), {BEST}
select (k//10)::bigint image_id, (k%10)::int class_id, g::int ann_id, d::int det_id, round(v, 6) iou from best"""

#: From per (g truths, d detections, and tps, the matches at each threshold) the phrase metrics.
PHRASES = """k as (select g, d, 50+5*i pct, tps[i+1] tp from per, range(10) t(i)),
l as (select *, tp/(tp+(d-tp)+1e-4::double) lp, tp/(tp+(g-tp)+1e-4::double) lr from k),
c as (select pct, sum(tp)::bigint tp, sum(d-tp)::bigint fp, sum(g-tp)::bigint fn, sum(case when g>0 then d-tp else 0 end)::bigint pos_fp, avg(case when g>0 and d>0 then 2*lp*lr/(lp+lr+1e-4::double) end) macro,
  count_if(g>0 and d>0)::double itp, count_if(g=0 and d>0)::double ifp, count_if(g>0 and d=0)::double ifn, count_if(g=0 and d=0)::double itn from l group by 1),
f as (select *, tp/(tp+fp+1e-4::double) pr, tp/(tp+fn+1e-4::double) re, tp/(tp+pos_fp+1e-4::double) pp, itp/(itp+ifp+1e-6::double) ip, itp/(itp+ifn+1e-6::double) ir,
  (itp*itn-ifp*ifn)/(sqrt((itp+ifp)*(itp+ifn)*(itn+ifp)*(itn+ifn))+1e-6::double) mcc from c)
select pct::int iou_percent, tp, fp, fn, pos_fp, round(macro, 6) positive_macro_f1, itp::bigint il_tp, ifp::bigint il_fp, ifn::bigint il_fn, itn::bigint il_tn, round(2*pr*re/(pr+re+1e-4::double), 6) f1, round(2*pp*re/(pp+re+1e-4::double), 6) positive_micro_f1,
  round(2*ip*ir/(ip+ir+1e-6::double), 6) il_f1, round(ifp/(ifp+itn+1e-6::double), 6) il_fpr, round(mcc, 6) il_mcc, round(2*pp*re/(pp+re+1e-4::double)*mcc, 6) cgf1 from f"""
TPS = "[" + ", ".join(f"count_if(round(v, 12) >= {p}/100.0::double)" for p in range(50, 100, 5)) + "]"
NONE = "[" + ", ".join("0" for _ in range(10)) + "]::bigint[]"


def phrases(truths: str, dets: str, iou: str) -> str:
    """Phrase metrics of exhaustive images from tables of truths (a) and detections (b) and the overlap of a pair."""
    return f"""ei as (select id from img where is_instance_exhaustive=1), pr as (select a.image_id k, a.ann_id::bigint g, b.det_id::bigint d, {iou} v from {truths} a join {dets} b using (image_id) where a.image_id in (select id from ei) and {iou} > 0), {BEST},
per as (select coalesce(n_gt, 0) g, coalesce(n_dt, 0) d, coalesce(tps, {NONE}) tps from ei left join (select image_id id, count(*) n_gt from {truths} group by 1) using (id)
  left join (select image_id id, count(*) n_dt from {dets} group by 1) using (id) left join (select k id, {TPS} tps from best group by 1) using (id)), {PHRASES}"""


SOME = "ga as (select * from gt where iscrowd=0), da as (select * from dt where score>=0.5)"
ORACLE["phrase_cgf1"] = f"with recursive {GT}, {DT}, {IMG}, {SOME}, {phrases('ga', 'da', iou_sql('a', 'b'))}"
ELL = f"({ell_inter('a', 'b')})::double/nullif(a.area+b.area-{ell_inter('a', 'b')}, 0)"
ORACLE["mask_phrase_cgf1"] = f"with recursive {GT}, {DT}, {IMG}, {SOME}, {ell_sql('ma', 'ga', 4)}, {ell_sql('mb', 'da', 4)}, {phrases('ma', 'mb', ELL)}"

ORACLE["oracle_annotator"] = f"""with recursive {GT}, {DT}, {IMG}, {SOME}, sets as (select *, 0 n from ga union all select * replace (x+2 as x), 1 from ga where sk%7<>0 union all select * replace (y+5 as y), 2 from ga where pk%6<>0),
pr as (select a.image_id*4+a.n k, a.ann_id::bigint g, b.det_id::bigint d, {iou_sql('a', 'b')} v from sets a join da b using (image_id) where {iou_sql('a', 'b')} > 0), {BEST},
per as (select id, n annotator, coalesce(n_gt, 0) g, coalesce(n_dt, 0) d, coalesce(tps, {NONE}) tps from img cross join range(3) t(n) left join (select image_id id, n, count(*) n_gt from sets group by 1, 2) using (id, n)
  left join (select image_id id, count(*) n_dt from da group by 1) using (id) left join (select k//4 id, k%4 n, {TPS} tps from best group by 1, 2) using (id, n)),
s as (select id, annotator, g=0 and d=0 tn, round(list_sum(list_transform(tps, lambda tp: 2*(tp/(d+1e-4::double))*(tp/(g+1e-4::double))/(tp/(d+1e-4::double)+tp/(g+1e-4::double)+1e-4::double)))/10, 6) mean_f1 from per)
select id image_id, annotator::int annotator, mean_f1, tn from s qualify row_number() over (partition by id order by tn desc, mean_f1 desc, annotator) = 1"""

ORACLE["one_to_one_association"] = f"""with recursive {TD}, pr as (select t.video_id*100000+t.frame_idx k, t.track_id::bigint g, d.track_id::bigint d, {iou_sql('t', 'd')} v from tg t join td d using (video_id, frame_idx) where {iou_sql('t', 'd')} >= 0.5), {BEST}
select td.video_id, td.frame_idx, td.track_id det_id, td.score, b.g track_id, round(b.v, 6) iou, b.g is null and td.score>=0.7 is_new from td left join best b on b.k=td.video_id*100000+td.frame_idx and b.d=td.track_id"""


def hota(truths: str, dets: str, sim: str, keys: str = "video_id") -> str:
    """hs: tp, fn, fp, ass_a, loc_a, ass_re and ass_pr of each sequence (q) and alpha, from tables of truths and detections with q, frame_idx and track_id."""
    on = ", ".join(keys.split(", "))
    return f"""sm as (select {on}, frame_idx, a.track_id g, b.track_id d, {sim} v from {truths} a join {dets} b using ({on}, frame_idx) where {sim} > 0),
ns as (select *, v/(sum(v) over (partition by {on}, frame_idx, g)+sum(v) over (partition by {on}, frame_idx, d)-v) s from sm), ca as (select {on}, track_id g, count(*) ng from {truths} group by all), cb as (select {on}, track_id d, count(*) nd from {dets} group by all),
al as (select {on}, g, d, sum(s)/(any_value(ng)+any_value(nd)-sum(s)) al from ns join ca using ({on}, g) join cb using ({on}, d) group by all),
kk as (select {on}, frame_idx, row_number() over () k from (select distinct {on}, frame_idx from sm)),
pr as (select k, g::bigint g, d::bigint d, al*v v from sm join al using ({on}, g, d) join kk using ({on}, frame_idx)), {BEST},
hit as (select {on}, g, d, sm.v from best join kk using (k) join sm using ({on}, frame_idx, g, d)), alphas as (select 5*i alpha from range(1, 20) t(i)),
pa as (select {on}, alpha, g, d, count(*) c, sum(v) s from hit join alphas on v >= alpha/100.0::double-2.220446049250313e-16::double group by all),
su as (select {on}, alpha, sum(c) tp, sum(s) s, sum(c*c/greatest(1, ng+nd-c)) a, sum(c*c/ng) re, sum(c*c/nd) p from pa join ca using ({on}, g) join cb using ({on}, d) group by all),
sz as (select {on}, coalesce(n, 0) n, coalesce(m, 0) m from (select {on}, count(*) n from {truths} group by all) full join (select {on}, count(*) m from {dets} group by all) using ({on})),
hs as (select {on}, alpha, coalesce(tp, 0)::bigint tp, (n-coalesce(tp, 0))::bigint fn, (m-coalesce(tp, 0))::bigint fp, coalesce(a, 0)/greatest(1, coalesce(tp, 0)) ass_a, case when n=0 or m=0 or coalesce(tp, 0)=0 then 1 else s/tp end loc_a,
  coalesce(re, 0)/greatest(1, coalesce(tp, 0)) ass_re, coalesce(p, 0)/greatest(1, coalesce(tp, 0)) ass_pr from sz cross join alphas left join su using ({on}, alpha))"""


SCORES = """fin as (select *, tp/greatest(1, tp+fn+fp) det_a, tp/greatest(1, tp+fn) det_re, tp/greatest(1, tp+fp) det_pr from {t}),
out as (select *, sqrt(det_a*ass_a) hota, sqrt(det_re*ass_a) owta from fin)"""
COMBINED = "cm as (select {k}alpha, sum(tp)::bigint tp, sum(fn)::bigint fn, sum(fp)::bigint fp, sum(ass_a*tp)/greatest(1, sum(tp)) ass_a, sum(loc_a*tp)/greatest(1, sum(tp)) loc_a, sum(ass_re*tp)/greatest(1, sum(tp)) ass_re, sum(ass_pr*tp)/greatest(1, sum(tp)) ass_pr from hs group by all)"
NAMES = ["det_a", "ass_a", "loc_a", "hota", "det_re", "det_pr", "ass_re", "ass_pr", "owta"]
ROUNDED = ", ".join(f"round({c}, 6) {c}" for c in NAMES)
MEANS = ", ".join(f"round(avg({c}), 6) {c}" for c in NAMES)
ORACLE["hota_by_video"] = f"with recursive {TD}, ts as (select * from td where score>0.1), {hota('tg', 'ts', iou_sql('a', 'b'))}, {SCORES.format(t='hs')} select video_id, alpha::int alpha, tp, fn, fp, {ROUNDED} from out"
ORACLE["hota_combined"] = f"with recursive {TD}, {hota('tg', 'td', iou_sql('a', 'b'))}, {COMBINED.format(k='')}, {SCORES.format(t='cm')} select alpha::int alpha, tp, fn, fp, {ROUNDED} from out"
ORACLE["mask_hota"] = f"with recursive {TD}, {ell_sql('ma', 'tg', 2)}, {ell_sql('mb', 'td', 2)}, {hota('ma', 'mb', ELL)}, {COMBINED.format(k='')}, {SCORES.format(t='cm')} select alpha::int alpha, tp, fn, fp, {ROUNDED} from out"
ORACLE["class_averaged_hota"] = (
    f"with recursive {TD}, {hota('tg', 'td', iou_sql('a', 'b'), 'video_id, category_id')}, {COMBINED.format(k='category_id, ')}, {SCORES.format(t='cm')}"
    f" select alpha::int alpha, sum(tp)::bigint tp, sum(fn)::bigint fn, sum(fp)::bigint fp, {MEANS} from out group by 1"
)

# -- average precision: detections of an image and class take truths one by one, for each threshold and range of areas

AREAS = [("all", "0.0", "1e10"), ("small", "0.0", "1024.0"), ("medium", "1024.0", "9216.0"), ("large", "9216.0", "1e10")]


def precision(truths: str, dets: str, inter: str, g_area: str, d_area: str, keys: str = "class_id", areas: int = 4) -> str:
    """ap: keys, t, a, n_gt, ap and recall of every class, threshold and range of areas with truths, and fl, the flags of detections. `keys` is what is
    averaged apart and then the class; tables hold image_id and keys; `inter` is the overlap of g and d in area."""
    image = f"image_id, {keys}"
    ranges = ", ".join(f"({k}, {lo}::double, {hi}::double)" for k, (_, lo, hi) in enumerate(AREAS[:areas]))
    return f"""pp as (select {image}, g.ann_id::bigint ann_id, d.det_id, g.iscrowd c, ({g_area})::double ga, {inter}/(case when g.iscrowd=1 then {d_area} else {g_area}+{d_area}-{inter} end)::double v from {truths} g join {dets} d using ({image}) where {inter} > 0),
dn as (select {image}, det_id, score, ({d_area})::double da, row_number() over (partition by {image} order by score desc, det_id) r from {dets} d),
ta as (select i t, least((50+5*i)/100.0::double, 1-1e-10::double) thr, k a, lo, hi from range(10) x(i), (values {ranges}) y(k, lo, hi)),
st as (select {image}, t, a, 0::bigint r, []::bigint[] used, null::bigint det_id, null::int flag from (select distinct {image} from dn) cross join ta
  union all
  select {", ".join(f"s.{c}" for c in image.split(", "))}, s.t, s.a, s.r+1, case when max(p.ann_id) is null then any_value(s.used) else list_append(any_value(s.used), max(case when p.ann_id is not null then struct_pack(nc := p.c=0 and p.ga between ta.lo and ta.hi, v := p.v, a := p.ann_id) end).a) end,
    any_value(dn.det_id)::bigint, case when max(p.ann_id) is null then case when any_value(dn.da between ta.lo and ta.hi) then 0 else -1 end
      when max(case when p.ann_id is not null then struct_pack(nc := p.c=0 and p.ga between ta.lo and ta.hi, v := p.v, a := p.ann_id) end).nc then 1 else -1 end
  from st s join ta on ta.t=s.t and ta.a=s.a join dn on {" and ".join(f"dn.{c}=s.{c}" for c in image.split(", "))} and dn.r=s.r+1 and dn.r <= 100
  left join pp p on {" and ".join(f"p.{c}=s.{c}" for c in image.split(", "))} and p.det_id=dn.det_id and p.v >= ta.thr and (p.c=1 or not list_contains(s.used, p.ann_id))
  group by {", ".join(f"s.{c}" for c in image.split(", "))}, s.t, s.a, s.r),
fl as (select {image}, st.t, st.a, st.r, det_id, flag, score from st join dn using ({image}, det_id) where st.r > 0),
cu as (select {keys}, t, a, flag, sum((flag=1)::int) over w tp, sum((flag>=0)::int) over w n from fl window w as (partition by {keys}, t, a order by score desc, image_id, det_id rows unbounded preceding)),
ng as (select {keys}, a, count_if(iscrowd=0 and ({g_area}) between lo and hi) n_gt from {truths} g cross join (select distinct a, lo, hi from ta) group by all having n_gt > 0),
hi as (select {keys}, t, a, least(floor(tp/n_gt*100+1e-9::double), 100) gi, max(tp/n) p from cu join ng using ({keys}, a) where flag=1 group by all),
gr as (select {keys}, t, a, g, max(p) p from hi join range(101) x(g) on gi >= g group by all),
ap as (select {keys}, t, a, n_gt, coalesce(s, 0)/101 ap, coalesce(tp, 0)/n_gt recall from ng cross join (select distinct t from ta) left join (select {keys}, t, a, sum(p) s from gr group by all) using ({keys}, t, a)
  left join (select {keys}, t, a, count_if(flag=1) tp from fl group by all) using ({keys}, t, a))"""


def summary(apart: str = "") -> str:
    """The summary of ap and fl, for each value of `apart` (a column and a comma)."""
    rows = [("AP", "avg(ap) filter (a=0)"), ("AP_50", "avg(ap) filter (a=0 and t=0)"), ("AP_75", "avg(ap) filter (a=0 and t=5)")]
    rows += [(f"AP_{n}", f"avg(ap) filter (a={k})") for k, (n, *_) in enumerate(AREAS) if k] + [("AR@100", "avg(recall) filter (a=0)")] + [(f"AR_{n}", f"avg(recall) filter (a={k})") for k, (n, *_) in enumerate(AREAS) if k]
    parts = [f"select {apart}'{m}' metric, coalesce({v}, -1) \"value\" from ap group by all" for m, v in rows]
    for most in (1, 10):
        parts.append(
            f"select {apart}'AR@{most}', coalesce(avg(coalesce(tp, 0)/n_gt), -1) from (select * from ap where a=0) left join (select {apart}class_id, t, count_if(flag=1) tp from fl where a=0 and r <= {most} group by all) using ({apart}class_id, t) group by all"
        )
    return " union all ".join(parts)


def rounded_summary() -> str:
    return f", su as ({summary()}) select metric, round(\"value\", 6) \"value\" from su"


BOXES = (inter_sql("g", "d"), "g.w*g.h", "d.w*d.h")
MASKS = (f"({ell_inter('g', 'd')})::double", "g.area", "d.area")
ORACLE["coco_average_precision"] = f"with recursive {GT}, {DT}, {precision('gt', 'dt', *BOXES, areas=1)} select class_id, (50+5*t)::int iou_percent, round(ap, 6) ap, round(recall, 6) recall from ap"
ORACLE["precision_by_area"] = f"with recursive {GT}, {DT}, {precision('gt', 'dt', *BOXES)}{rounded_summary()}"
ORACLE["precision_on_positives"] = f"with recursive {GT}, {DT}, dp as (select * from dt where (image_id, class_id) in (select image_id, class_id from gt)), {precision('gt', 'dp', *BOXES)}{rounded_summary()}"
ORACLE["mask_average_precision"] = f"with recursive {GT}, {DT}, {ell_sql('ma', 'gt', 4)}, {ell_sql('mb', 'dt', 4)}, {precision('ma', 'mb', *MASKS)}{rounded_summary()}"
ORACLE["precision_by_rarity"] = (
    f"with recursive {GT}, {DT}, {IMG}, gb as (select gt.*, rarity bucket from gt join img on img.id=gt.image_id), db as (select dt.*, rarity bucket from dt join img on img.id=dt.image_id), {precision('gb', 'db', *BOXES, keys='bucket, class_id')},"
    f" su as ({summary('bucket, ')}) select bucket, metric, round(\"value\", 6) \"value\" from su union all select null, metric, round(avg(\"value\"), 6) from su group by 2"
)
