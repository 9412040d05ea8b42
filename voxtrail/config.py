"""Thresholds of the engine, as one frozen record."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Thresholds:
    # Defaults that results depend on.
    target_fps: float = 10.0
    min_confidence: float = 0.5
    min_points: int = 50
    max_extent_m: float = 30.0
    survivor_min_obs: int = 3
    survivor_max_extent_m: float = 15.0
    background_speed: float = 0.1
    background_area: float = 0.7
    background_size: float = 0.03
    smooth_window: int = 5
    velocity_half_window: int = 2
    velocity_min_span_s: float = 1e-6
    kalman_accel: float = 0.5
    kalman_noise: float = 0.03
    kalman_zref: float = 1.0
    kalman_gate: float = 3.0
    lost_after: int = 5
    archived_after: int = 35
    relink_gap_s: float = 0.6
    relink_jump: float = 0.2
    relink_cosine: float = 0.88
    reid_cosine: float = 0.72
    reid_distance: float = 0.25
    merge_cosine: float = 0.94
    merge_distance: float = 0.25
    merge_shared: int = 2
    fusion_iou: float = 0.4
    fusion_distance_m: float = 2.0
    fusion_relative: float = 0.2
    mask_dedup_iou: float = 0.85
    overlap_iom: float = 0.3
    association_iou: float = 0.5
    loop_similarity: float = 0.85
    loop_gap: int = 10
    loop_nms: int = 25
    confirm_after: int = 3
    boundary_margin: float = 0.025
    texture_std: float = 20.0
    texture_edges: float = 0.015
    crop_std: float = 12.0
    obb_percentile: float = 0.02
    huber_delta: float = 0.1
    huber_iterations: int = 20


DEFAULTS = Thresholds()
