"""Fixed values that must equal the reference's for results to match.

FIXED VALUES — labels, edges and names exactly as the reference uses them,
stated once, in natural order.
"""

# Freight buckets (global quintiles of freight value), lowest to highest.
FREIGHT_LABELS = ["Sangat murah", "Murah", "Sedang", "Mahal", "Sangat mahal"]

# Risk levels over the late probability: (0, .3], (.3, .6], (.6, 1].
RISK_EDGES = [0.0, 0.3, 0.6, 1.0]
RISK_LABELS = ["Low Risk", "Medium Risk", "High Risk"]

# Ratio of actual to estimated delivery days.
RATIO_EDGES = [0.0, 0.5, 0.75, 1.0, 1.5, 20.0]
RATIO_LABELS = ["<50%", "50-75%", "75-100%", "100-150%", ">150%"]

# Approval delay in hours; the last edge is the observed maximum.
APPROVAL_EDGES = [0.0, 1.0, 12.0, 24.0, 48.0, 100.0]
APPROVAL_LABELS = ["<1h", "1-12h", "12-24h", "24-48h", "48-100h", ">100h"]
APPROVAL_TAIL_HOURS = [100.0, 200.0, 500.0]

# Delivery days buckets for the review-score breakdown.
DELIVERY_EDGES = [0, 7, 14, 21, 30, 200]
DELIVERY_LABELS = ["<7d", "7-14d", "14-21d", "21-30d", ">30d"]

# Days-late buckets for the customer-tolerance breakdown (late orders only).
DAYS_LATE_EDGES = [0, 3, 7, 14, 30, 200]
DAYS_LATE_LABELS = ["1-3d late", "4-7d late", "8-14d late", "15-30d late", ">30d late"]

MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun",
               "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# Monday = 0 ... Sunday = 6.
DAY_NAMES = ["Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu"]
WEEKEND_LABELS = {0: "Hari Kerja", 1: "Weekend"}

# Parts of the day by purchase hour: [0,6), [6,12), [12,18), [18,24).
TIME_PERIODS = ["Dini Hari (00-06)", "Pagi (06-12)", "Siang (12-18)", "Malam (18-24)"]

# Severity colours of the notebook charts: (high, mid) thresholds per chart.
SEVERITY_MISSING = (20.0, 5.0)
SEVERITY_MONTH = (15.0, 8.0)
SEVERITY_STATE = (15.0, 8.0)
SEVERITY_COHORT = (10.0, 7.0)
SEVERITY_FREIGHT = (10.0, 7.0)

# KPI table.
KPI_ON_TIME = "On-Time Delivery Rate"
KPI_BREACH = "Customer Tolerance Breach Rate"
KPI_SLA = "SLA Accuracy Rate"
KPI_SELLER = "Late Rate per Seller (avg aktif)"
KPI_PROCESSING = "Processing Time Compliance"
KPI_PASS = "✅"
KPI_FAIL = "❌"

# Brazilian state code -> name (27 entries).
STATE_NAMES = {
    "AC": "Acre", "AL": "Alagoas", "AM": "Amazonas", "AP": "Amapá",
    "BA": "Bahia", "CE": "Ceará", "DF": "Distrito Federal", "ES": "Espírito Santo",
    "GO": "Goiás", "MA": "Maranhão", "MG": "Minas Gerais", "MS": "Mato Grosso do Sul",
    "MT": "Mato Grosso", "PA": "Pará", "PB": "Paraíba", "PE": "Pernambuco",
    "PI": "Piauí", "PR": "Paraná", "RJ": "Rio de Janeiro", "RN": "Rio Grande do Norte",
    "RO": "Rondônia", "RR": "Roraima", "RS": "Rio Grande do Sul", "SC": "Santa Catarina",
    "SE": "Sergipe", "SP": "São Paulo", "TO": "Tocantins",
}

UNKNOWN = "unknown"
