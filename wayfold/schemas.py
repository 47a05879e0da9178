"""Record contracts as Spark types."""

from pyspark.sql import types as T

_D, _S, _L, _I, _B = T.DoubleType(), T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _st(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


VERTICES = T.ArrayType(_st(x=_D, y=_D))
POINTS = _st(drive_id=_S, frame_id=_L, pt_id=_L, x=_D, y=_D, z=_D, intensity=T.FloatType())
POSES = _st(drive_id=_S, frame_id=_L, x=_D, y=_D, z=_D, roll=_D, pitch=_D, yaw=_D)
SUPPORT = _st(points_support=_L, points_support_accum=_L, reproj_iou_bbox=_D, reproj_iou_dilated=_D)
UNCERTAINTY = _st(drift_flag=_B, details=T.MapType(_S, _S))
PROVENANCE = _st(config_path=_S, git_commit=_S, generated_at=_S)
PRIMITIVE_EVIDENCE = _st(kind=_S, provider_id=_S, model_id=_S, model_version=_S, source=_S, drive_id=_S, frame_id=_S, geom_crs=_S, geometry=VERTICES,
                         quality=_st(score=_D), support=SUPPORT, uncertainty=UNCERTAINTY, provenance=PROVENANCE, backend_status=_S, fallback_used=_B,
                         fallback_from=_S, fallback_to=_S, backend_reason=_S, timestamp=T.TimestampType())
WORLD_CANDIDATE = _st(candidate_id=_S, version=_S, drive_id=_S, geom_crs=_S, geometry=VERTICES, quality=_st(score=_D), support=SUPPORT, uncertainty=UNCERTAINTY,
                      provenance=PROVENANCE, rect_w=_D, rect_l=_D, rectangularity=_D, drift_flag=_B, prop_reason=_S, reject_reasons=T.ArrayType(_S))
TOPO_ISSUE = _st(issue_id=_S, tile_id=_S, involved_edges=T.ArrayType(_S), involved_nodes=T.ArrayType(_S), rule_failed=_S, severity=_S, description=_S,
                 recommend_actions=T.ArrayType(_S), evidence_summary=T.MapType(_S, _S), error_code=_S)
TOPO_ACTION = _st(action_id=_S, tile_id=_S, action_type=_S, reason_rule=_S, nodes_before=T.ArrayType(_S), nodes_after=T.ArrayType(_S), edges_before=T.ArrayType(_S),
                  edges_after=T.ArrayType(_S), intersection_bucket_id=_L, metrics=T.MapType(_S, _D), related_issue_ids=T.ArrayType(_S))

# allowed values (fixed values)
KINDS = ("seg_map", "det", "poly", "line")
SOURCES = ("image", "lidar", "sat", "traj")
CRS = ("pixel", "utm32", "wgs84")
BACKENDS = ("real", "fallback", "unavailable")
SEVERITIES = ("S0", "S1", "S2", "S3")
