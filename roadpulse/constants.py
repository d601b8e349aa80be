"""Results depend on these being exactly as written."""

# ---- fixed values: confidence cut-offs per detection source ----
VEHICLE_CONFIDENCE = 0.3
ACCIDENT_CONFIDENCE = 0.8
REPORT_CONFIDENCE = 0.4

# ---- fixed values: vehicle classes and motorcycle-equivalent units ----
VEHICLE_NAMES = {0: "motorcycle", 1: "car", 2: "bus", 3: "truck"}
MEU_COEFFICIENTS = {0: "1.000", 1: "3.236", 2: "8.568", 3: "10.000"}
MEU_MAX_DEFAULT = 200.0
THRESHOLD_DEFAULT = 1.0

# ---- fixed values: density gate, speed model, smoothing ----
OCCUPANCY_GATE = 20.0
RAMP_LOW, RAMP_HIGH = 70.0, 90.0
FREE_FLOW_DEFAULT_KMH = 50.0
GREENSHIELDS_N = 1.0
MIN_SPEED_KMH = 3.0
EMA_ALPHA = 0.3

# ---- fixed values: retired routing weights by hybrid congestion index ----
COST_GATE = 85.0
COST_JAM_RATIO, COST_JAM = 0.9, 0.1
COST_SLOW_RATIO, COST_SLOW = 0.8, 0.5
COST_NORMAL = 1.0

# ---- fixed values: status names and hysteresis bounds on 1 - speed / free flow ----
GREEN, YELLOW, RED = "GREEN", "YELLOW", "RED"
STATUSES = (GREEN, YELLOW, RED)
YELLOW_EXIT, YELLOW_ENTER, RED_EXIT, RED_ENTER = 0.30, 0.40, 0.60, 0.75

# ---- fixed values: seconds ----
CYCLE_SECONDS = 20
EDGE_STATE_TTL = 1200
FRESH_SECONDS = 900
STREAK_TTL = 50
ALERT_COOLDOWN = 300
ALERT_STREAK = 3

# ---- fixed values: incidents ----
INCIDENT_CLASSES = ("human_incident", "vehicle_incident")

# ---- fixed values: calibration ----
ROAD_HITS_DEFAULT = 100
ROAD_FRAME_RATIO = 0.30
MIN_RELIABLE_FRAMES = 50
PREVIEW_CAMERAS = 20

# ---- fixed values: images ----
JPEG_MIN_BYTES = 5_000
UPLOAD_MAX_BYTES = 10 * 1024 * 1024

# ---- fixed values: geometry ----
LAT_RANGE = (9.5, 11.5)
LON_RANGE = (105.5, 107.5)
POLYLINE_SCALE = 1_000_000

# ---- fixed values: queue ----
CYCLE_SENTINEL = "__CYCLE_END__"
QUEUE_BATCH = 100
BACKLOG_RATIO = 0.5
HISTORY_TIME_ZONE = "Asia/Ho_Chi_Minh"
UNKNOWN_SPEED_CODE = 127
GRAPH_TILE_BITS = 25

# ---- fixed values: snapshot address ----
SNAPSHOT_QUERY = "&bg=black&w=500&h=500"

# First bytes of JPEG, PNG, GIF (two), BMP and TIFF (two) files; fixed values.
IMAGE_MAGIC = (b"\xff\xd8", b"\x89PNG\r\n\x1a\n", b"GIF87a", b"GIF89a", b"BM", b"II*\x00", b"MM\x00*")
